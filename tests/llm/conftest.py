from __future__ import annotations

import pytest


@pytest.fixture(scope="session", autouse=True)
def _package(spark):
    from kpi_lake.llm.common import ship_package

    ship_package(spark)


@pytest.fixture()
def documents(spark):
    """A frame of ``(doc_id, text)`` rows with extra columns whose names clash with inner ones."""

    def make(rows, partitions=3):
        kinds = "doc_id bigint, text string, id string, k1 int, spans string, node string, packed string, n bigint"
        return spark.createDataFrame([(i, t, "x", 1, "s", "n", "p", 7) for i, t in rows], kinds).repartition(partitions)

    return make
