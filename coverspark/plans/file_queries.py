"""Sources and sinks: tables of the driver written to files in the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverspark.plans.registry import PIXELS, ctes, query, table
from coverspark.session import read, scratch_path
from coverspark.sources import files

_RAW = "SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '-9' WHEN 1 THEN '*' ELSE p_name END AS name, CASE WHEN p_size % 3 > 0 THEN 'é \"' || p_type || '\", x' END AS remark FROM part"


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN p_size % 5 > 1 THEN p_name END AS name, CASE WHEN p_size % 3 > 0 THEN 'é \"' || p_type || '\", x' END AS remark FROM part")
def delimited_scan(spark, d):
    """Quoted text with null tokens and signs of its own, written and scanned."""
    path = scratch_path(spark)
    files.write_quoted(table(spark, d, _RAW), path)
    return files.read_delimited(spark, path).drop("file_name")


@query("SELECT dataset, count(*) AS n FROM (SELECT 'orders' AS dataset FROM orders UNION ALL SELECT 'part' FROM part) GROUP BY 1")
def dataset_of_file(spark, d):
    """The dataset's name from the name of the scanned file."""
    names = [read(spark, d, t).select(F.col("_metadata.file_path").alias("f")) for t in ("orders", "part")]
    both = names[0].unionByName(names[1]).withColumn("f", F.regexp_extract("f", r"([^/]*\.parquet)", 1))
    return both.groupBy(files.dataset_name(F.col("f"), ".parquet").alias("dataset")).agg(F.count("*").alias("n"))


@query("SELECT array_to_string(list_sort(list(DISTINCT p_type)), '-') || '_' || min(1990 + p_size) || '-' || max(1990 + p_size) AS label FROM part")
def site_year_label(spark, d):
    p = table(spark, d, "SELECT p_type || '_' || (1990 + p_size) || '_x.csv' AS f FROM part")
    return files.output_label(p.select(files.name_part(F.col("f"), 1).alias("site"), files.name_part(F.col("f"), 2).cast("int").alias("year")), "site", "year")


@query("SELECT CASE WHEN p_size % 2 = 0 THEN 'deciduous' ELSE 'evergreen' END AS leaf_retention, p_name AS retention_name FROM part")
def sheet_with_renames(spark, d):
    """A sheet without a header: its columns named, one renamed, listed values replaced."""
    path = scratch_path(spark)
    table(spark, d, "SELECT CASE WHEN p_size % 2 = 0 THEN 'D ' ELSE 'E' END AS leaf, p_name AS name FROM part").write.csv(path)
    return files.read_named(spark, path, ["leaf_retention", "name"], {"name": "retention_name"}, {"leaf_retention": {"D": "deciduous", "E": "evergreen"}}, header=False)


_TILES = "SELECT CASE line % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'nir' ELSE 'blue' END AS band, CAST(cell_id AS INT) AS cell_id, x, y, value FROM p"


@query(ctes(p=PIXELS) + f", t AS ({_TILES}) SELECT * FROM t WHERE band IN ('red', 'nir') AND cell_id IN (2, 5, 11)")
def tile_scan(spark, d):
    """Pixels in folders by band and cell; only the folders asked for are read."""
    path = scratch_path(spark)
    files.write_units(table(spark, d, _TILES.replace("FROM p", f"FROM ({PIXELS}) p")), path, ["band", "cell_id"])
    return files.read_tiles(spark, path, ["red", "nir"], [2, 5, 11]).select("band", "cell_id", "x", "y", "value")


@query("SELECT 'u' || (1000000000 + o_orderkey) AS visit_id, o_orderpriority AS accepted_species_name, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS fcover FROM orders")
def validated_export(spark, d):
    """Conformed to its schema, checked and written; an unknown column is left out, text becomes numbers."""
    path = scratch_path(spark)
    o = table(spark, d, "SELECT o_orderstatus AS other, 'u' || (1000000000 + o_orderkey) AS visit_id, o_orderpriority AS accepted_species_name, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_totalprice AS STRING) ELSE 'n/a' END AS fcover FROM orders")
    files.export(o, "synthesized_species_fcover", path)
    return spark.read.parquet(path)


@query("SELECT o_orderstatus AS unit, count(*) AS n, sum(o_totalprice) AS total FROM (SELECT o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders) GROUP BY 1")
def units_overwritten(spark, d):
    """All units written, then one of them again: the others stay as they are."""
    path, o = scratch_path(spark), table(spark, d, "SELECT o_orderstatus AS unit, o_orderkey, o_totalprice FROM orders")
    files.write_units(o, path, ["unit"])
    files.write_units(o.where("unit = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, ["unit"])
    return spark.read.parquet(path).groupBy("unit").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))


_DESCRIBED = "SELECT p_size % 4 AS grp, p_partkey + 2 AS ord, CAST(p_partkey AS VARCHAR(20)) || ',' || '\"' || p_name || ', ' || p_type || '\",' || CASE p_size % 5 WHEN 0 THEN '-9' ELSE p_brand END AS line FROM part"


@query("""SELECT CAST(p_partkey AS VARCHAR) AS code, p_name || ', ' || p_type AS name, CASE WHEN p_size % 5 > 0 THEN p_brand END AS kind FROM part
  UNION ALL SELECT 'a number', 'text', 'letters' FROM (SELECT DISTINCT p_size % 4 FROM part)""")
def described_scan(spark, d):
    """Files with a row of descriptions under the header, left out by its place: the data row that reads like it, last in each file, stays."""
    path, lines = scratch_path(spark), table(spark, d, _DESCRIBED)
    fixed = F.explode(F.array(*(F.struct(F.lit(o).cast("long").alias("ord"), F.lit(t).alias("line")) for o, t in ((0, "code,name,kind"), (1, "a number,text,letters"), (1 << 40, "a number,text,letters")))))
    all_ = lines.unionByName(lines.select("grp").distinct().select("grp", fixed.alias("l")).select("grp", "l.ord", "l.line"))
    all_.repartition("grp").sortWithinPartitions("grp", "ord").select("grp", "line").write.partitionBy("grp").text(path)
    return files.read_described(spark, f"{path}/*/*.txt", "code string, name string, kind string").drop("file_name")


@query("SELECT p_size % 7 AS grp, p_size % 7 IN (2, 5) AS broken, count(*) > 0 AS has_rows FROM part GROUP BY ALL")
def unreadable_files(spark, d):
    """Parquet files, and among them others, told by their first four bytes."""
    path, p = scratch_path(spark), table(spark, d, "SELECT p_size % 7 AS grp, p_name FROM part")
    p.where("grp not in (2, 5)").write.partitionBy("grp").parquet(path)
    p.where("grp in (2, 5)").write.mode("append").partitionBy("grp").text(path)
    grp = F.regexp_extract("path", "grp=([0-9]+)", 1).cast("long")
    bad = files.unreadable(spark, f"{path}/*/part-*", b"PAR1").select(grp.alias("grp"), F.lit(True).alias("broken"))
    every = files.heads(spark, f"{path}/*/part-*", 4).select(grp.alias("grp"), (F.col("length") > 4).alias("has_rows"))
    return every.groupBy("grp").agg(F.max("has_rows").alias("has_rows")).join(bad.distinct(), "grp", "left").select("grp", F.coalesce("broken", F.lit(False)).alias("broken"), "has_rows")
