"""From the two sources and the mapping to stored marts, checked on the way.

Each step stops the run when its checks fail; every table is a full replace, so
a run can be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import GridLayout, PanelConfig, layer_name
from panelkit.operators import checks, grid
from panelkit.plans import index_file, marts
from panelkit.sources import tables
from panelkit.sources.snapshot import Snapshot
from panelkit.sources.staging import shared_dir


@dataclass(frozen=True)
class GridSource:
    """What is known about the sheets beforehand."""

    headers: Sequence[str]
    self_names: Mapping[str, str]
    aliases: Mapping[str, str] = field(default_factory=dict)
    layout: GridLayout = GridLayout()
    n_sheets: int = 8


@dataclass(frozen=True)
class Layers:
    """Where the tables of each layer go."""

    raw: str = "raw"
    marts: str = "marts"
    staging: str = "staging"


def grid_suite(cells: DataFrame, result: grid.GridResult, source: GridSource, reference: DataFrame | None) -> checks.Suite:
    """Layout errors, trees that differ, and the shape of both panels."""
    spark = cells.sparkSession
    alone = spark.createDataFrame(list(source.self_names.items()), "header string, member string")
    named_alone = result.tree.filter(F.col("header").isin(*source.self_names))
    suite = (
        checks.Suite()
        .add("sheet count", checks.sheet_count(cells, source.n_sheets))
        .add("layout", result.errors)
        .add("same tree on every sheet", grid.tree_consistency(result.tree).filter(~F.col("same_tree")))
        .add("groups with a single member", grid.tree_difference(named_alone, alone))
        .add("member grain", checks.unique_combination(result.members, ["member_label", "year", "quarter"]))
        .add("published grain", checks.unique_combination(result.published, ["group_header", "year", "quarter"]))
        .add("members x periods", checks.complete_grid(result.members, "member_label", ["year", "quarter"]))
    )
    if reference is not None:
        suite.add("reference tree", grid.tree_difference(result.tree, reference))
    return suite


def load_raw(
    spark: SparkSession,
    index_path: str,
    cells: DataFrame,
    source: GridSource,
    n_geographies: int,
    reference: DataFrame | None = None,
    layers: Layers = Layers(),
) -> None:
    """Parse both sources, check them and replace the raw tables, all three at once."""
    parsed = index_file.parse_index(index_file.read_index(spark, index_path))
    path = f"{shared_dir(spark)}/staged/index-parsed-{uuid.uuid4().hex}"
    tables.write_parquet(parsed, path)
    index = tables.read_parquet(spark, path, index_file.INDEX_SCHEMA)
    checks.require(index_file.index_checks(index, n_geographies).run())
    result = grid.parse_grid(cells, source.headers, source.self_names, source.aliases, source.layout)
    checks.require(grid_suite(cells, result, source, reference).run())

    tables.create_namespace(spark, layers.raw, "Parsed source tables")
    snapshot = Snapshot(spark, layers.raw)
    tables.store_table(snapshot, index, "index_long", index_file.INDEX_SCHEMA)
    tables.store_table(snapshot, result.members, "member_quarter", marts.MEMBER_SCHEMA)
    tables.store_table(snapshot, result.published, "published_quarter", marts.PUBLISHED_SCHEMA)
    snapshot.publish()


def raw_inputs(spark: SparkSession, mapping: DataFrame, cfg: PanelConfig, layers: Layers = Layers()) -> marts.PanelInputs:
    """The staged views over the raw tables."""

    def view(df: DataFrame, name: str) -> DataFrame:
        return tables.materialise_view(df, layer_name(name, layers.staging, "staging").replace(".", "_"))

    return marts.PanelInputs(
        index_long=view(index_file.stage_index(tables.source(spark, layers.raw, "index_long"), cfg.national_code), "index_long"),
        members=view(marts.stage_members(tables.source(spark, layers.raw, "member_quarter")), "member_quarter"),
        published=view(marts.stage_published(tables.source(spark, layers.raw, "published_quarter")), "published_quarter"),
        mapping=mapping,
    )


def build_marts(
    inputs: marts.PanelInputs, cfg: PanelConfig, first_year: int, n_entities: int, layers: Layers = Layers()
) -> marts.Models:
    """Check the inputs, build the models, check them and publish the marts.

    Each mart is written once, as a version of its own, and all of them are published at once when all checks have
    passed; until then, and after a run that stops anywhere, readers have those of the last run.
    """
    checks.require(marts.input_suite(inputs).run())
    spark = inputs.mapping.sparkSession
    tables.create_namespace(spark, layers.marts, "Marts")
    snapshot = Snapshot(spark, layers.marts)
    models = marts.build_models(inputs, cfg, snapshot.store, snapshot.store)
    checks.require(marts.model_suite(models, cfg, first_year, n_entities).run())
    published = snapshot.publish()
    return marts.Models(inputs, models.annual, models.groups, *[published[name] for name in marts.MARTS])
