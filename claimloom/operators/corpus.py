"""Content-addressed corpus: documents, hits, paragraphs, blocks, fingerprints and gates."""

from __future__ import annotations

import html.parser
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom.functions.text import document_id, fallback_key, normalize_ws, text_hash


def content_keys(captures: DataFrame) -> DataFrame:
    """text_sha ('' without text) and corpus_id of each capture (text, source_url, title)."""
    h = text_hash(F.col("text"))
    key = F.when(h != "", h).otherwise(fallback_key(F.col("source_url"), F.col("title")))
    return captures.withColumn("text_sha", h).withColumn("corpus_id", document_id(key))


def unique_documents(keyed: DataFrame) -> DataFrame:
    """The first capture of each corpus_id; a mergeable aggregate, so copies of one text never meet in one task."""
    first = F.min_by(F.struct("doc_id", "source_domain", "text_sha"), F.col("doc_id"))
    return keyed.groupBy("corpus_id").agg(first.alias("f"), F.count("*").alias("captures")).select("corpus_id", "f.doc_id", "f.source_domain", "f.text_sha", "captures")


def paragraphs(docs: DataFrame, least: int = 40) -> DataFrame:
    """doc_id, position, char_offset and text of each line of at least `least` characters.

    The offset is a running sum over a text's lines as rows, linear in the length of the text. A text delivered twice keeps both
    its copies' lines apart by a number of the row.
    """
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    t = rows.select("doc_id", "_row", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("position", "paragraph"))
    before = Window.partitionBy("_row").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    p = t.withColumn("char_offset", F.coalesce(F.sum(F.length("paragraph") + 1).over(before), F.lit(0)).cast("int"))
    return p.where(F.length(F.trim("paragraph")) >= least).select("doc_id", "position", "char_offset", "paragraph")


def fingerprint(docs: DataFrame, id_col: str, hash_cols: list[str]) -> DataFrame:
    """documents and fingerprint of each run, whatever the order of its rows: SHA-256 over the sums of the eight parts of the row hashes.

    The sums are mergeable, so that a run (rows without one are a run too) of any size is hashed map-side; every row counts as often as it stands there.
    """
    row = F.concat_ws("|", F.col(id_col).cast("string"), *[F.coalesce(F.col(c), F.lit("")) for c in hash_cols])
    hashed = docs.select("run_id", F.sha2(row, 256).alias("_h"))
    quarters = [F.sum(F.conv(F.substring("_h", 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")).alias(f"_q{k}") for k in range(8)]
    g = hashed.groupBy("run_id").agg(F.count("*").alias("documents"), *quarters)
    return g.select("run_id", "documents", F.sha2(F.concat_ws(",", *[F.col(f"_q{k}").cast("string") for k in range(8)]), 256).alias("fingerprint"))


def qa_metrics(docs: DataFrame) -> DataFrame:
    """Duplicate ratio, shares and two gates of a corpus in one aggregate."""
    h = text_hash(F.col("text"))
    has = h != ""
    agg = docs.agg(
        F.count("*").alias("documents"),
        F.count_if(has).alias("text_documents"),
        F.count_distinct(F.when(has, h)).alias("distinct_texts"),
        F.count_if(F.coalesce("is_metadata_only", F.lit(False))).alias("metadata_only"),
        F.count_if(F.coalesce("backfilled", F.lit(False))).alias("backfilled"),
        F.count_if(F.length(normalize_ws(F.coalesce("text", F.lit("")))) < 200).alias("short_texts"),
    )
    dup = F.round(1 - F.try_divide(F.col("distinct_texts").cast("double"), F.col("text_documents").cast("double")), 3)
    meta = F.round(F.try_divide(F.col("metadata_only").cast("double"), F.col("documents").cast("double")), 3)
    return agg.withColumn("duplicate_ratio", dup).withColumn("metadata_share", meta).withColumn("gate_duplicates", dup < 0.10).withColumn("gate_metadata", meta < 0.15)


def qa_gates(docs: DataFrame, background: Column, has_table: Column) -> DataFrame:
    """The four gates of a corpus and whether all are passed: copies, pages without text, background sources, and whether there are tables at all."""
    share = docs.agg(F.round(F.avg(background.cast("int")), 3).alias("background_share"), F.count_if(has_table).alias("documents_with_tables"))
    m = qa_metrics(docs).join(F.broadcast(share), how="cross")  # two single rows
    m = m.withColumns({"gate_background": F.col("background_share") < 0.15, "gate_tables": F.col("documents_with_tables") > 0})
    return m.withColumn("passed", F.col("gate_duplicates") & F.col("gate_metadata") & F.col("gate_background") & F.col("gate_tables"))


class _Blocks(html.parser.HTMLParser):
    SKIP = {"script", "style", "noscript", "nav", "header", "footer", "aside"}
    HEAD, CELL = {"h1", "h2", "h3", "h4"}, {"td", "th"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skip, self.buf, self.kind, self.blocks, self.row, self.table = 0, [], "", [], [], []

    def _close(self):
        text = " ".join("".join(self.buf).split())
        if text and self.kind in ("heading", "paragraph"):
            self.blocks.append((self.kind, text))
        self.buf, self.kind = [], ""

    def _end_cell(self):
        if self.kind == "cell":
            self.row.append(" ".join("".join(self.buf).split()))
            self.buf, self.kind = [], ""

    def _end_row(self):
        self._end_cell()
        if any(self.row):
            self.table.append(self.row)
        self.row = []

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.skip += 1
        elif not self.skip:
            if tag in self.HEAD or tag in ("p", "li"):
                self._close()
                self.kind = "heading" if tag in self.HEAD else "paragraph"
            elif tag == "table":
                self._close()
                self.table = []
            elif tag == "tr":
                self._end_row()  # cells and rows may lack their end tags
            elif tag in self.CELL:
                self._end_cell()
                self.buf, self.kind = [], "cell"

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif not self.skip:
            if tag in self.HEAD or tag in ("p", "li"):
                self._close()
            elif tag in self.CELL:
                self._end_cell()
            elif tag == "tr":
                self._end_row()
            elif tag == "table":
                self._end_row()
                if len(self.table) >= 2:
                    self.blocks.append(("table", "\n".join(" | ".join(r) for r in self.table)))
                self.table = []

    def handle_data(self, data):
        if not self.skip and self.kind:
            self.buf.append(data)


def html_blocks(text: str | None, least: int = 40) -> list[tuple[str, str]]:
    """(type, text) of headings, paragraphs of at least `least` characters and tables of two or more rows."""
    p = _Blocks()
    p.feed(text or "")
    p._close()
    return [(k, t) for k, t in p.blocks if k != "paragraph" or len(t) >= least]


def page_blocks(pages: DataFrame, key: str = "doc_id", source: str = "html") -> DataFrame:
    """key, position, block_type, block_text: a page is parsed once, in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, i, t, x) for k, src in zip(b.column("key").to_pylist(), b.column("src").to_pylist()) for i, (t, x) in enumerate(html_blocks(src))]
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field("key").type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())], names=[key, "position", "block_type", "block_text"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(F.col(key).alias("key"), F.col(source).alias("src")).mapInArrow(run, f"`{key}` {kind}, position int, block_type string, block_text string")


def next_revision(previous: DataFrame, current: DataFrame) -> DataFrame:
    """run_id, fingerprint, revision: one more than before only where the fingerprint changed."""
    p = previous.select("run_id", F.col("fingerprint").alias("old"), F.col("revision").alias("old_revision"))
    rev = F.when(F.col("old").isNull(), 1).when(F.col("old") == F.col("fingerprint"), F.col("old_revision")).otherwise(F.col("old_revision") + 1)
    return current.join(p, "run_id", "left").select("run_id", "fingerprint", rev.cast("int").alias("revision"), F.when(F.col("old") != F.col("fingerprint"), F.col("old")).alias("previous_fingerprint"))


class _Sections(_Blocks):
    """Blocks with their section: the heading above, its level and an anchor; captions of tables; the date in the head."""

    DATES = {"article:published_time", "citation_publication_date", "dc.date", "date", "datepublished"}

    def __init__(self):
        super().__init__()
        self.level, self.id, self.captions, self.date, self.rows = 0, "", [], "", []

    def handle_starttag(self, tag, attrs):
        got = dict(attrs)
        if tag == "meta" and not self.date and (got.get("name") or got.get("property") or got.get("itemprop") or "").lower() in self.DATES:
            self.date = (got.get("content") or "").strip()
        super().handle_starttag(tag, attrs)
        self._sync()
        if not self.skip and tag in self.HEAD:
            self.level, self.id = int(tag[1]), got.get("id") or ""
        elif not self.skip and tag == "caption":
            self.buf, self.kind = [], "caption"

    def handle_endtag(self, tag):
        if tag == "caption" and self.kind == "caption":
            self.captions.append(" ".join("".join(self.buf).split()))
            self.buf, self.kind = [], ""
        super().handle_endtag(tag)
        self._sync()

    def _sync(self):
        """What is known of the blocks that have just been closed."""
        for kind, _ in self.blocks[len(self.rows) :]:
            self.rows.append((self.level, self.id, "") if kind == "heading" else (0, "", self.captions.pop() if kind == "table" and self.captions else ""))


def html_sections(text: str | None, least: int = 40) -> list[tuple[str, str, str, int, str, str, str]]:
    """(type, text, section, level, anchor, caption, date) of a page's blocks: the section is the nearest heading above; a heading without an id has its slug for anchor."""
    p = _Sections()
    p.feed(text or "")
    p.close()
    p._close()
    p._sync()
    out, section, level, anchor = [], "", 0, ""
    for (kind, block), (n, own, caption) in zip(p.blocks, p.rows):
        if kind == "heading":
            section, level = block, n
            anchor = own or "-".join("".join(c if c.isalnum() else " " for c in block.lower()).split())
        elif kind == "paragraph" and len(block) < least:
            continue
        out.append((kind, block, section, level, anchor, caption, p.date))
    return out


def page_sections(pages: DataFrame, key: str = "doc_id", source: str = "html") -> DataFrame:
    """key, position, block_type, block_text, section, level, anchor, caption, date of each block; a page that cannot be parsed raises."""
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
    names = [key, "position", "block_type", "block_text", "section", "level", "anchor", "caption", "date"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, i, *x) for k, src in zip(b.column("key").to_pylist(), b.column("src").to_pylist()) for i, x in enumerate(html_sections(src))]
            cols = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return pages.select(F.col(key).cast("bigint").alias("key"), F.col(source).alias("src")).mapInArrow(run, f"{key} bigint, position int, block_type string, block_text string, section string, level int, anchor string, caption string, date string")
