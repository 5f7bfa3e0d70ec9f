"""The seven declared tables, conforming to them and their violations."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, StringType, StructField, StructType

from coverspark.functions.text import list_text
from coverspark.operators import validate as V

_TEXT, _NUMBER, _WHOLE, _TEXTS, _WHOLES = StringType(), DoubleType(), IntegerType(), ArrayType(StringType()), ArrayType(IntegerType())


def _schema(*groups: tuple[DataType, bool, str]) -> StructType:
    """Fields from (type, may be null, names)."""
    return StructType([StructField(n, kind, optional) for kind, optional, names in groups for n in names.split()])


_COVERS = "deciduous_shrub deciduous_tree evergreen_shrub evergreen_tree forb graminoid nonvascular_sum bryophyte lichen litter other bareground water"
_COVERS = " ".join(f"{c}_cover" for c in _COVERS.split())
_KEY = (_TEXT, False, "visit_id")
_PLOT = ((_WHOLE, True, "survey_year survey_month survey_day"), (_NUMBER, True, "plot_area"), (_TEXT, True, "plot_shape"), (_NUMBER, True, "latitude_y longitude_x"), (_TEXT, True, "georef_source"), (_NUMBER, True, "georef_accuracy"), (_TEXT, True, "coord_epsg"))

# Fields of the tables and which may be null, allowed words, and the tables whose key must be unique.
SCHEMAS = {
    "species_fcover": _schema(_KEY, (_TEXT, False, "dataset_species_name standard_habit"), (_TEXT, True, "nonstandard_habit"), (_NUMBER, True, "fcover")),
    "pft_fcover": _schema(_KEY, (_NUMBER, True, _COVERS)),
    "pft_aux": _schema(_KEY, *_PLOT, (_TEXT, True, "plot_name data_subsource data_source data_source_html data_subsource_citation survey_method fcover_scale survey_purpose geometry"), (_WHOLES, True, "fire_years"), (_TEXTS, True, "duplicated_coords duplicated_date")),
    "species_pft_checklist": _schema((_TEXT, False, "dataset_species_name accepted_species_name"), (_TEXT, True, "accepted_species_name_author"), (_TEXTS, False, "visit_id data_source data_subsource"), (_TEXT, False, "taxon_rank"), (_TEXT, True, "naming_authority category habit"), (_TEXT, False, "pft"), (_TEXT, True, "nonstandard_pft")),
    "synthesized_pft_fcover": _schema(_KEY, (_NUMBER, True, _COVERS)),
    "synthesized_aux": _schema(_KEY, *_PLOT, (_TEXT, False, "plot_name data_subsource data_source data_source_html data_subsource_citation"), (_TEXT, True, "survey_method"), (_TEXT, False, "fcover_scale survey_purpose admin_unit admin_country"), (_WHOLES, False, "fire_years"), (_TEXT, False, "bioclim_subzone"), (_TEXTS, True, "duplicated_coords duplicated_date"), (_TEXT, False, "cavm_unit cavm_unit_description")),
    "synthesized_species_fcover": _schema(_KEY, (_TEXT, False, "accepted_species_name"), (_NUMBER, True, "fcover")),
}
PFTS = ["evergreen shrub", "deciduous shrub", "evergreen tree", "deciduous tree", "graminoid", "bryophyte", "lichen", "other", "litter", "water", "bare ground", "forb"]
RANKS = ["type", "family", "genus", "species", "subspecies", "variety"]
LEAST_KEY = {"species_fcover": 10, "pft_fcover": 10, "pft_aux": 10}
UNIQUE_KEY = {"pft_fcover": "visit_id", "pft_aux": "visit_id", "synthesized_pft_fcover": "visit_id", "synthesized_aux": "visit_id", "species_pft_checklist": "dataset_species_name"}


def conform(df: DataFrame, schema: str | StructType) -> DataFrame:
    """The declared columns in their order and types; absent ones are null, others left out, what can't be cast is null.

    A list given as text (`[...]`, or one value) becomes a list, a null one stays null. Columns `name.0`, `name.1` of exploded
    lists are left out like all others.
    """
    declared = SCHEMAS[schema] if isinstance(schema, str) else schema
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(f: StructField):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, ArrayType):
            c = c if isinstance(have[f.name], ArrayType) else F.when(c.isNotNull(), list_text(c.cast("string")))
            return F.transform(c, lambda x: x.cast("string").try_cast(f.dataType.elementType)).alias(f.name)
        return c.cast("string").try_cast(f.dataType).alias(f.name)

    return df.select(*map(column, declared.fields))


def list_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Each named column as a list (null: empty, one value: a list of it), without the columns that exploding left."""
    exploded = [c for c in df.columns if any(re.fullmatch(re.escape(n) + r"\.\d+", c) for n in names)]
    kept = df.select(*(F.col(f"`{c}`") for c in df.columns if c not in exploded))
    lists = {n: F.coalesce(F.col(n), F.array().cast(df.schema[n].dataType)) if isinstance(df.schema[n].dataType, ArrayType) else list_text(F.col(n).cast("string")) for n in names}
    return kept.withColumns(lists)


def trimmed(df: DataFrame, but: str) -> DataFrame:
    """All texts trimmed but one column, whose spelling counts."""
    return df.withColumns({c: F.trim(f"`{c}`") for c, t in df.dtypes if t == "string" and c != but and "." not in c})


def violations(df: DataFrame, schema: str) -> DataFrame:
    """(rule, key, detail, severity) of all rules of a declared table, df conformed to it first.

    Missing columns and other types, nulls where none may be, length of the key, its uniqueness where the table has one row
    per key, and for the checklist the words of its vocabularies.
    """
    declared, spark = SCHEMAS[schema], df.sparkSession
    key = "dataset_species_name" if schema == "species_pft_checklist" else "visit_id"
    own = conform(df, declared)
    found = [V.schema_differences(spark, df.schema, declared), V.nulls(own, key, declared)]
    if schema in LEAST_KEY:
        found.append(V.bad_key(own, key, "", LEAST_KEY[schema]))
    if schema in UNIQUE_KEY:
        found.append(V.not_unique(own.where(F.col(key).isNotNull()), key))
    if schema == "species_pft_checklist":
        found += [V.not_allowed(own, key, "pft", PFTS), V.not_allowed(own, key, "taxon_rank", RANKS)]
    return reduce(DataFrame.unionByName, found)


def same_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """(position, have, wanted) where the columns' order differs from that of another table; no row if it is the same."""
    a, b = list(df.columns), list(like.columns)
    n = max(len(a), len(b))
    rows = [(k, x, y) for k, (x, y) in enumerate(zip(a + [None] * (n - len(a)), b + [None] * (n - len(b)))) if x != y]
    return df.sparkSession.createDataFrame(rows, "position int, have string, wanted string")
