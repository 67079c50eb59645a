"""Configuration and cached files: runs, manifests, vocabularies, registries, extraction caches, schemas.

Each is a small JSON file (or a folder of them) that becomes a dimension of a few hundred rows; what must be unique or present is
checked once, when the dimension is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.sources.files import _exists

#: Record kinds by name: the schemas that files are read and checked with.
SCHEMAS: dict[str, str] = {
    "run": "run_id string, crop string, parameter_ids array<string>, source_tier_ids array<string>, region_scope struct<level:string,name:string>, parameter_manifest_path string, crop_profile_path string, seeds array<struct<url:string,parameter_ids:array<string>>>",
    "parameter": "parameter_id string, label string, family string, status string, aliases array<string>, normalized_attribute string, normalized_attribute_subtype string, value_type string, common_unit string",
    "crop": "crop_id string, label string, crop_group string, aliases array<string>, scientific_names array<string>",
    "mode": "mode_id string, label string, directionality string, query_templates array<string>",
    "node": "node_type string, node_id string, label string, aliases array<string>, botanical_family string, genus string, functional_groups array<string>, host_groups array<string>",
    "tier": "tier_id string, label string, priority int, query_terms array<string>, providers array<string>",
    "seed": "seed_id string, url string, title string, parameter_ids array<string>, crops array<string>, source_tier_id string",
    "extraction": "parameter_id string, claim_summary string, evidence_text string, value_type string, numeric_value double, range_min double, range_max double, unit string, qualifier string, extraction_confidence string",
}


def schema(name: str) -> T.StructType:
    """The record schema of a name (a path and an ending .json or .schema.json aside); KeyError for unknown ones."""
    base = name.rsplit("/", 1)[-1].removesuffix(".json").removesuffix(".schema")
    return T.StructType.fromDDL(SCHEMAS[base])


def _one(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).option("multiLine", True).option("mode", "FAILFAST").json(path)


def records(spark: SparkSession, path: str, field: str, kind: str) -> DataFrame:
    """The records of a file {field: [...]} with their position; fails on files that do not match the schema."""
    df = _one(spark, path, f"{field} array<struct<{T.StructType.fromDDL(SCHEMAS[kind]).simpleString()[7:-1]}>>")
    return df.select(F.posexplode(field).alias("pos", "r")).select("pos", "r.*")


def unique(df: DataFrame, key: str, what: str, empty_ok: bool = False) -> DataFrame:
    """df, if its key is set and different in every row (and there is a row)."""
    n = df.agg(F.count("*").alias("n"), F.count_distinct(key).alias("d"), F.count(key).alias("k")).first()
    if n["k"] < n["n"] or n["d"] < n["k"]:
        raise ValueError(f"{what}: {key} is missing or not unique")
    if not n["n"] and not empty_ok:
        raise ValueError(f"{what}: empty")
    return df


def run_config(spark: SparkSession, folder: str, run_id: str, required: bool = True) -> dict | None:
    """The run of an id among the files of a folder, the first by file name; None or an error where there is none."""
    runs = spark.read.schema(SCHEMAS["run"]).option("multiLine", True).json(f"{folder}/*.json").withColumn("_f", F.col("_metadata.file_name"))
    found = runs.where(F.col("run_id") == run_id).orderBy("_f").limit(1).drop("_f").collect()
    if not found and required:
        raise KeyError(f"no run {run_id}")
    return found[0].asDict(True) if found else None


def parameter_manifest(spark: SparkSession, path: str) -> DataFrame:
    return unique(records(spark, path, "parameters", "parameter"), "parameter_id", "parameters")


def active_parameter_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids of the active parameters; none where there is no file."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "parameter_id string")
    return records(spark, path, "parameters", "parameter").where(F.coalesce("status", F.lit("active")) == "active").select("parameter_id")


def crop_profile(spark: SparkSession, path: str) -> DataFrame:
    return unique(_one(spark, path, SCHEMAS["crop"]), "crop_id", "crop profile")


def crop_universe(spark: SparkSession, folder: str) -> DataFrame:
    """All crop profiles of a folder, in order of their id; ids must differ, and there must be one."""
    return unique(_one(spark, f"{folder}/*.json", SCHEMAS["crop"]), "crop_id", "crops").orderBy("crop_id")


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Modes with pos and is_default; a mode may stand once, and every default must be a mode."""
    modes = unique(records(spark, path, "modes", "mode"), "mode_id", "modes")
    defaults = _one(spark, path, "default_modes array<string>").select(F.explode_outer("default_modes").alias("mode_id")).where("mode_id is not null")
    if not defaults.join(modes.select("mode_id"), "mode_id", "left_anti").isEmpty():
        raise ValueError("a default mode is not defined")
    return modes.join(F.broadcast(defaults.distinct().withColumn("is_default", F.lit(True))), "mode_id", "left").withColumn("is_default", F.coalesce("is_default", F.lit(False)))


def node_catalog(spark: SparkSession, path: str) -> DataFrame:
    return records(spark, path, "nodes", "node")


def aggregate_nodes(spark: SparkSession, path: str, kinds: tuple[str, ...]) -> DataFrame:
    """Nodes of some kinds in order of (type, id); an error where there is none."""
    nodes = node_catalog(spark, path).where(F.col("node_type").isin(*kinds))
    if nodes.isEmpty():
        raise ValueError("no node of these kinds")
    return nodes.orderBy("node_type", "node_id")


def source_tiers(spark: SparkSession, path: str) -> DataFrame:
    return unique(records(spark, path, "tiers", "tier"), "tier_id", "tiers")


def query_templates(spark: SparkSession, path: str) -> DataFrame:
    """parameter_id, pos, template; empty where there is no file."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "parameter_id string, pos int, template string")
    return _one(spark, path, "templates map<string,array<string>>").select(F.explode("templates").alias("parameter_id", "t")).select("parameter_id", F.posexplode("t").alias("pos", "template"))


def seed_registry(spark: SparkSession, path: str) -> DataFrame:
    return unique(records(spark, path, "seeds", "seed"), "seed_id", "seeds")


def seeds_for_run(run: dict, registry: DataFrame) -> DataFrame:
    """url, parameter_ids: the run's own seeds where it has any, else those of the registry that name its crop (or none) and one of its parameters (or none)."""
    spark = registry.sparkSession
    if run.get("seeds"):
        return spark.createDataFrame([(s["url"], s["parameter_ids"]) for s in run["seeds"]], "url string, parameter_ids array<string>")
    own = F.size(F.coalesce("crops", F.array().cast("array<string>"))) == 0
    crop = own | F.array_contains("crops", run.get("crop") or "")
    ids = run.get("parameter_ids") or []
    wanted = F.arrays_overlap("parameter_ids", F.array(*[F.lit(i) for i in ids])) if ids else F.lit(True)
    return registry.where(crop & F.coalesce(wanted | (F.size("parameter_ids") == 0), F.lit(True))).select("url", "parameter_ids")


def extraction_cache(spark: SparkSession, folder: str) -> DataFrame:
    """document_id (the file's stem) and the fields of each cached extraction, with pos; a document without any has one row of nulls; no folder, no rows."""
    ddl = f"claims array<struct<{T.StructType.fromDDL(SCHEMAS['extraction']).simpleString()[7:-1]}>>"
    if not _exists(spark, f"{folder}/*.json"):
        return spark.createDataFrame([], f"document_id string, pos int, {SCHEMAS['extraction']}")
    df = spark.read.schema(ddl).option("multiLine", True).json(f"{folder}/*.json").select(F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("document_id"), "claims")
    return df.select("document_id", F.posexplode_outer("claims").alias("pos", "c")).select("document_id", "pos", "c.*")


def vault_claims(spark: SparkSession, folder: str, ddl: str) -> DataFrame:
    """Claims of the files named *claim*.json; broken files are skipped."""
    return spark.read.schema(ddl).option("multiLine", True).option("mode", "DROPMALFORMED").option("pathGlobFilter", "*claim*.json").json(folder)
