"""Directly addressable codes: codec against plain lists, files against the tokenizers library."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpi_lake.llm import dac, queries
from kpi_lake.llm.common import scratch_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary_path())


def in_memory(data: bytes) -> dac.Shard:
    return dac.Shard(lambda n, at: data[at : at + n])


@pytest.mark.parametrize("width", range(1, 33))
def test_pack_round_trip(width):
    values = np.random.default_rng(width).integers(0, 1 << width, 70_001, dtype=np.uint64).astype(np.uint32)
    assert (dac.unpack(dac.pack(values, width), width, len(values)) == values).all()


@pytest.mark.parametrize("top", [1, 2, 300, 50_257, 1 << 24, (1 << 32) - 1])
def test_every_id_is_read_directly(top):
    rng = np.random.default_rng(top)
    ids = (rng.pareto(0.5, 5000) * 3).clip(0, top).astype(np.uint32)
    shard = in_memory(dac.build_shard([7, None], np.array([10, 5000]), ids))
    assert (shard.all_tokens() == ids).all()
    assert [shard.token(i) for i in range(0, 5000, 7)] == ids[::7].tolist()
    assert shard.documents()[0] == [7, None] and shard.documents()[1].tolist() == [10, 5000]
    with pytest.raises(IndexError):
        shard.token(5000)


def test_widths_are_the_best_of_all():
    import itertools

    ids = (np.random.default_rng(1).pareto(0.7, 3000) * 2).clip(0, 1000).astype(np.uint32)
    top = int(ids.max()).bit_length()

    def size(cuts):
        edges = [0, *cuts, top]
        return sum(np.count_nonzero((ids >> a) > 0 if a else ids >= 0) * (b - a + (1 + 64 / dac.RANK_BITS) * (b < top)) for a, b in zip(edges, edges[1:], strict=False))

    widths = dac.best_widths(ids)
    best = min(size(c) for k in range(top) for c in itertools.combinations(range(1, top), k))
    assert sum(widths) == top and size(np.cumsum(widths)[:-1].tolist()) == pytest.approx(best)


def test_a_file_without_ids_and_one_of_zeros():
    assert in_memory(dac.build_shard([], np.array([], np.int64), np.array([], np.uint32))).all_tokens().tolist() == []
    shard = in_memory(dac.build_shard([1], np.array([3]), np.zeros(3, np.uint32)))
    assert shard.all_tokens().tolist() == [0, 0, 0] and shard.token(2) == 0


ODD = ["", None, "a", "  two  blanks", "line\n\nline\n", "<|endoftext|> it's\t42 %% é ü", "x" * 300, "don't 's 1,000 #a\nb c", "a\x1cb c", "日本 語", "z" * 48 + " " + "y" * 60]


def test_files_hold_the_librarys_ids(spark, documents, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "again"), (3, "again"), (10**12, "last")]
    folder = scratch_path(spark, "dac")
    manifest = dac.write_tokens(documents(rows), folder, queries.vocabulary_path(), roll_ids=40, range_bytes=200)
    assert manifest.count() > 3
    got = sorted(dac.read_documents(spark, folder).collect(), key=lambda r: r.start)
    assert [r.id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start, stream, texts = 0, [], {}
    for i, t in rows:
        texts.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [0])
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert list(r.ids) in texts[r.id]
        texts[r.id].remove(list(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
        stream += r.ids
    assert manifest.agg(F.sum("n_ids")).first()[0] == start
    wanted = spark.range(-1, start + 2).select(F.col("id").alias("position")).unionByName(spark.sql("select cast(null as bigint) as position"))
    found = {r.position: r.token for r in dac.tokens_at(spark, folder, wanted).collect()}
    assert [found[i] for i in range(start)] == stream
    assert found[-1] is None and found[start] is None and found[None] is None


def test_writing_again_gives_equal_files(spark, documents):
    rows = [(i, f"text {i} " * (i % 5)) for i in range(60)]
    sums = []
    for parts in (2, 5):
        manifest = dac.write_tokens(documents(rows, parts), scratch_path(spark, "dac"), queries.vocabulary_path(), roll_ids=50, range_bytes=1 << 20)
        sums.append(sorted((r.file, r.crc32, r.start) for r in manifest.collect()))
    assert sums[0] == sums[1]


def test_an_empty_table(spark, documents):
    folder = scratch_path(spark, "dac")
    assert dac.write_tokens(documents([]), folder, queries.vocabulary_path()).count() == 0
    assert dac.read_documents(spark, folder).count() == 0
    assert dac.tokens_at(spark, folder, spark.range(2).withColumnRenamed("id", "position")).where("token is null").count() == 2


def test_damage_is_noticed(spark, documents):
    from kpi_lake.session import local_path

    folder = scratch_path(spark, "dac")
    name = dac.write_tokens(documents([(1, "some text")]), folder, queries.vocabulary_path()).first().file
    path = f"{local_path(folder)}/{name}"
    data = bytearray(open(path, "rb").read())
    data[-1] ^= 1
    with open(path, "wb") as f:
        f.write(data)
    with pytest.raises(Exception, match="manifest"):
        dac.read_documents(spark, folder).collect()


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    want, start = {}, 0
    for r in sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        want[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op13_direct_codes(spark, sf).collect()}
    assert got == want
