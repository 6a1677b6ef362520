"""kpi_lake: bronze -> silver -> gold table shaping and a KPI layer, on the PySpark DataFrame API.

Sub-packages
------------
``functions``  Column-level cleaning rules (recode, null rules, safe casts, calendar parts, formatting).
``sources``    Layered table IO (read / overwrite / schema replace / schema merge) and the stand-in
               bronze tables derived from the shared test tables.
``operators``  Star-schema builders, the relationship model (filter propagation), filter contexts,
               measures and time intelligence.
``plans``      Whole pipelines (bronze -> silver -> gold) and dashboard page queries.
``streaming``  Incremental (availableNow) variant of the row-local bronze -> silver step.

Everything returns lazy DataFrames; nothing in the library collects data to the driver.

Main entry points: ``plans.pipelines.run_all`` (refresh the layers), ``plans.catalog.gold_model``
(the model over written gold tables), ``operators.context.FilterContext`` (slicer selections),
``operators.measures.evaluate`` / ``evaluate_by`` (cards and charts), ``plans.dashboard.page``
(a whole report page), ``python -m kpi_lake`` (command line).
"""

from kpi_lake.session import get_spark, lake_root

__all__ = ["get_spark", "lake_root"]
