"""Sinks: run partitions, resumed appends, relational rows, JSON lines, notes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators.claims import latest


def write_runs(df: DataFrame, path: str, partition: str = "run_id") -> None:
    """Replaces exactly the runs that df holds (dynamic partition overwrite)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def append_new(df: DataFrame, path: str, key: list[str]) -> DataFrame:
    """Appends rows whose key isn't there yet; gives the rows written."""
    spark = df.sparkSession
    fresh = df.dropDuplicates(key)
    try:
        fresh = fresh.join(spark.read.parquet(path).select(*key), key, "left_anti")
    except Exception as e:  # nothing there yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    fresh.write.mode("append").parquet(path)
    return fresh


def write_json_lines(df: DataFrame, path: str) -> None:
    """Null fields are left out, as JSON writers of sparse records do."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def upserted(existing: DataFrame, arriving: DataFrame, key: list[str], version: str) -> DataFrame:
    """The table after an upsert: of each key the row of the greatest version."""
    return latest(existing.unionByName(arriving, allowMissingColumns=True), key, [version])


def relational_rows(claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source_documents, normalized_claims) rows of nested claims: flat columns, JSON text for scopes."""
    src = claims.where(F.col("provenance.source_urls").isNotNull()).select(F.explode("provenance.source_urls").alias("source_url"), F.col("provenance.source_title").alias("source_title"), F.col("provenance.source_domain").alias("source_domain"), "run_id", "inserted_at")
    sources = latest(src, ["source_url"], ["inserted_at"])
    flat = claims.select("claim_id", "run_id", "value.*", F.to_json("location_scope").alias("location_scope_json"), F.to_json("provenance").alias("provenance_json"), "inserted_at")
    return sources, latest(flat, ["claim_id"], ["inserted_at"])


def for_each_batch(df: DataFrame, write: Callable[[list[dict]], None], size: int = 1000) -> None:
    """Hands rows to an injected writer (a database client) in batches, partition by partition."""

    def part(rows) -> None:
        held: list[dict] = []
        for r in rows:
            held.append(r.asDict(True))
            if len(held) >= size:
                write(held)
                held = []
        if held:
            write(held)

    df.foreachPartition(part)


def notes(rows: DataFrame, key: list[str], title: str, body: str, marker: str = "<!-- generated -->") -> DataFrame:
    """One markdown note a key: marker, heading and the distinct body lines in order."""
    lines = F.array_join(F.array_sort(F.collect_set(F.concat(F.lit("- "), F.col(body)))), "\n")
    return rows.groupBy(*key).agg(F.min(title).alias("_t"), lines.alias("_l")).select(*key, F.concat_ws("\n", F.lit(marker), F.concat(F.lit("# "), F.coalesce("_t", F.lit(""))), F.lit(""), F.col("_l")).alias("note"))


# ------------------------------------------------------------ relational export
def durable_rows(durable: DataFrame) -> DataFrame:
    """Durable claims as flat rows, of each id the latest: scopes and provenance stay JSON text, empty texts become null."""
    texts = [f.name for f in durable.schema.fields if f.dataType.simpleString() == "string" and f.name != "durable_claim_id"]
    return latest(durable.select("durable_claim_id", *[F.nullif(F.col(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in durable.columns if c != "durable_claim_id"]), ["durable_claim_id"], ["promoted_at"])


def sql_literal(col, kind: str = "string"):
    """A value as SQL text: quotes doubled, NULL for null; numbers and booleans bare."""
    bare = col.cast("string")
    return F.coalesce(bare if kind in ("bigint", "int", "double", "boolean") else F.concat(F.lit("'"), F.replace(bare, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))


def upsert_statements(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """One insert-or-update statement a row, as an export file holds them."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    values = F.concat_ws(", ", *[sql_literal(F.col(c), kinds[c]) for c in df.columns])
    rest = ", ".join(f"{c} = EXCLUDED.{c}" for c in df.columns if c not in key)
    action = f"DO UPDATE SET {rest}" if rest else "DO NOTHING"
    return df.select(F.concat(F.lit(f"INSERT INTO {table} ({', '.join(df.columns)}) VALUES ("), values, F.lit(f") ON CONFLICT ({', '.join(key)}) {action};")).alias("statement"))


def write_jdbc(df: DataFrame, url: str | None, table: str, properties: dict[str, str] | None = None, batch: int = 1000) -> bool:
    """Appends to a staging table over JDBC, partition by partition; without a URL nothing is loaded. The upsert from the staging table is the database's."""
    if not url:
        return False
    df.write.mode("append").option("batchsize", batch).jdbc(url, table, properties=properties or {})
    return True


# ------------------------------------------------------------ reports and notes
def scorecard_markdown(metrics: DataFrame, title: str) -> DataFrame:
    """A table of metrics (columns as they are) as one markdown text: a report of a few rows."""
    names = metrics.columns
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in names]), F.lit(" |"))
    head = f"# {title}\n\n| {' | '.join(names)} |\n|{'---|' * len(names)}\n"
    return metrics.select(row.alias("r")).agg(F.concat(F.lit(head), F.array_join(F.array_sort(F.collect_list("r")), "\n")).alias("markdown"))


def gates_markdown(metrics: DataFrame, gates: list[str], title: str) -> DataFrame:
    """Gates of a one-row report as checkboxes."""
    box = lambda g: F.concat(F.when(F.col(g), "- [x] ").otherwise("- [ ] "), F.lit(g.removeprefix("gate_").replace("_", " ")))
    return metrics.select(F.concat_ws("\n", F.lit(f"# {title}"), F.lit(""), *[box(g) for g in gates]).alias("markdown"))


def value_display(value_type, value, low, high, text, unit):
    """A value as a reader sees it: the number or interval with its unit, else the text."""
    num = lambda c: F.regexp_replace(F.format_string("%.4f", c), r"\.?0+$", "")
    shown = F.when((value_type == "range") & low.isNotNull() & high.isNotNull(), F.concat_ws("–", num(low), num(high))).when(value.isNotNull(), num(value)).otherwise(F.coalesce(text, F.lit("")))
    return F.trim(F.concat_ws(" ", shown, F.coalesce(unit, F.lit(""))))


MARKER = "<!-- generated -->"


def vault_notes(claims: DataFrame) -> DataFrame:
    """path, note of a vault: a note a crop and parameter, a hub a crop, a note a source, an index. claims: entity_name, parameter_id, source_url, source_title, display.

    Four aggregates over distinct lines; a note's lines are what a reader sees of one key.
    """
    slug = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit("unknown"))), "[^a-z0-9]+", "-")
    c = claims.select("entity_name", "parameter_id", "source_url", "source_title", "display").distinct()

    def note(df: DataFrame, path, title, line, *key: str) -> DataFrame:
        lines = df.select(*[F.col(k) for k in key], line.alias("_line")).distinct().groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list("_line")), "\n").alias("_l"))
        return lines.select(path.alias("path"), F.concat_ws("\n", F.lit(MARKER), F.concat(F.lit("# "), title), F.lit(""), F.col("_l")).alias("note"))

    link = F.concat(F.lit("- [["), slug(F.col("entity_name")), F.lit("--"), slug(F.col("parameter_id")), F.lit("]]"))
    per = note(c, F.concat(F.lit("claims/"), slug(F.col("entity_name")), F.lit("--"), slug(F.col("parameter_id")), F.lit(".md")), F.concat_ws(": ", "entity_name", "parameter_id"), F.concat(F.lit("- "), F.col("display")), "entity_name", "parameter_id")
    hub = note(c, F.concat(F.lit("hubs/"), slug(F.col("entity_name")), F.lit(".md")), F.coalesce("entity_name", F.lit("unknown")), link, "entity_name")
    src = note(c.where("source_url is not null"), F.concat(F.lit("sources/"), F.sha1("source_url"), F.lit(".md")), F.col("source_url"), link, "source_url")
    index = hub.select(F.concat(F.lit("- "), F.col("path")).alias("l")).agg(F.array_join(F.array_sort(F.collect_list("l")), "\n").alias("l")).select(F.lit("index.md").alias("path"), F.concat_ws("\n", F.lit(MARKER), F.lit("# Index"), F.lit(""), "l").alias("note"))
    return per.unionByName(hub).unionByName(src).unionByName(index)


def commit_notes(notes_: DataFrame, read: Callable[[str], str | None], write: Callable[[str, str], None], marker: str = MARKER, dry: bool = False) -> dict[str, int]:
    """Writes notes through an injected store; a file that lacks the marker in its first 600 characters is someone else's and stays."""
    done = {"written": 0, "foreign": 0}
    for r in notes_.toLocalIterator():
        old = read(r["path"])
        if old is not None and marker not in old[:600]:
            done["foreign"] += 1
            continue
        done["written"] += 1
        if not dry:
            write(r["path"], r["note"])
    return done


def run_actions(events: list[tuple[str, dict]], actions: dict[str, list[tuple[str, Callable[[dict], None]]]]) -> list[dict]:
    """The audit rows of hooks: the actions of each event in order, their outcome; an event without actions leaves none, a failed action stops no other."""
    rows = []
    for event, payload in events:
        for pos, (name, act) in enumerate(actions.get(event, [])):
            try:
                act(payload)
                rows.append({"event": event, "position": pos, "action": name, "error": ""})
            except Exception as e:  # noqa: BLE001 a hook may fail in any way
                rows.append({"event": event, "position": pos, "action": name, "error": str(e)})
    return rows


def run_totals(summaries: dict[str, DataFrame]) -> DataFrame:
    """stage, metric, total: numeric columns of the stages' summaries added up over their runs."""
    out = None
    for stage, df in summaries.items():
        names = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("bigint", "int", "double")]
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in names])).alias("m")).select("m.*")
        part = long.groupBy("metric").agg(F.sum("v").alias("total")).select(F.lit(stage).alias("stage"), "metric", "total")
        out = part if out is None else out.unionByName(part)
    return out
