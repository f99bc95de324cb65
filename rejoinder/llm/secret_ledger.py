"""Secret scan with an incremental blob ledger (operator 6), DataFrame functions only.

Every historical version of a text is a blob named by the SHA-256 of its content. A ledger
table holds the (blob, rule version) pairs scanned so far with the spans found. A scan looks at
distinct blobs without a ledger entry only, appends them, and findings are joined back to
every path (row) that holds the blob.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.llm.columns import fresh
from rejoinder.session import scratch_path

RULES_VERSION = "1"

#: Kind, pattern, least characters, group that the length is taken from.
#: The last two patterns hold the least length, which gives the same spans as a filter afterwards.
RULES = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 20),
    ("hex", r"[0-9a-f]{24,}", 24),
]
#: The value at the end of an assignment.
ASSIGNED = r"""[A-Za-z0-9+/_.=-]+$"""

LEDGER_SCHEMA = "blob string, rule_version string, spans array<struct<start:int,kind_no:int,end:int>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


SPANS = "array<struct<start:int,kind_no:int,end:int>>"

#: Matches whose places are summed up together. A running array is copied at every step, so a text with n matches
#: costs n * MATCH_BLOCK and (n / MATCH_BLOCK) ** 2 steps in place of n ** 2.
MATCH_BLOCK = 256


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, kind_no: int) -> Column:
    """Leftmost matches of one rule as (start, kind, end) in code points.

    Splitting at the pattern gives the gaps between the matches; starts are running sums of gaps
    and matches, first inside blocks of matches, then over the blocks.
    """
    kind, pattern, least = RULES[kind_no]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.expr(f"cast(array() as {SPANS})")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        kept = F.when(_value_length(kind, pair["found"]) >= least, kind_no).otherwise(-1)
        span = F.struct(start.alias("start"), kept.alias("kind_no"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def walked(pairs: Column) -> Column:
        return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step)

    def blocks(pairs: Column) -> Column:
        first = F.sequence(F.lit(1), F.size(pairs), F.lit(MATCH_BLOCK))
        return F.transform(first, lambda n: walked(F.slice(pairs, n, MATCH_BLOCK)))

    def shifted(told: Column) -> Column:
        starts = F.aggregate(
            told,
            F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts")),
            lambda state, block: F.struct(
                (state["at"] + block["at"]).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts")
            ),
            lambda state: state["starts"],
        )
        moved = F.zip_with(told, starts, lambda block, at: F.transform(block["spans"], lambda span: F.struct(
            (span["start"] + at).alias("start"), span["kind_no"].alias("kind_no"), (span["end"] + at).alias("end")
        )))
        return F.filter(F.flatten(moved), lambda span: span["kind_no"] >= 0)

    def of_matches(found: Column) -> Column:
        # the gap after the last match starts no span
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        pairs = F.arrays_zip(gaps.alias("gap"), found.alias("found"))
        return F.when(F.size(found) > 0, _let(pairs, lambda p: _let(blocks(p), shifted))).otherwise(empty)

    return _let(matches, of_matches)


def _value_length(kind: str, found: Column) -> Column:
    if kind != "assign":
        return F.length(found)
    # the value starts after the separator and an optional quote; both ends of the match are known
    value = F.regexp_extract(found, RULES[0][1], 2)
    return F.length(value)


def spans_of(text: Column) -> Column:
    """All spans of a text, by start, then by kind as listed."""
    return F.array_sort(F.concat(*(_spans(text, k) for k in range(len(RULES)))))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; an empty one is started where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        spark.createDataFrame([], LEDGER_SCHEMA).write.parquet(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def scan_unseen(versions: DataFrame, ledger_path: str, rule_version: str = RULES_VERSION, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Scan the blobs of ``versions`` that the ledger lacks under ``rule_version``, append them, return the ledger's part for it.

    A blob with several rows is read from the row with the smallest id only. Appending the same
    blob twice (a rerun after a crash) does no harm: entries are made distinct when read.
    """
    spark = versions.sparkSession
    ledger = open_ledger(spark, ledger_path)
    blob, holder = fresh(versions, "blob", "holder")
    named = versions.select(F.col(id_col).alias(holder), F.coalesce(text_col, F.lit("")).alias("text"), blob_of(F.col(text_col)).alias(blob))
    known = ledger.where(F.col("rule_version") == rule_version).select(F.col("blob").alias(blob))
    unseen = named.groupBy(blob).agg(F.min(holder).alias(holder)).join(known, blob, "left_anti")
    texts = named.join(unseen, (named[blob] == unseen[blob]) & named[holder].eqNullSafe(unseen[holder]), "left_semi")
    found = texts.select(F.col(blob).alias("blob"), F.lit(rule_version).alias("rule_version"), spans_of(F.col("text")).alias("spans"))
    # rows that repeat an id and a text are one blob
    found.dropDuplicates(["blob"]).write.mode("append").parquet(ledger_path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path).where(F.col("rule_version") == rule_version).dropDuplicates(["blob"])


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(kind) for kind, _, _ in RULES))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def secret_report(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: spans by kind, their digest and list; a null text is empty and has none.

    The findings are few against the rows; a blob that a third of all rows share meets its one
    finding in a join that the adaptive skew join may split.
    """
    path = ledger_path or scratch_path(docs.sparkSession, "ledger")
    ledger = scan_unseen(docs, path)
    findings = ledger.where(F.size("spans") > 0).select("blob", "spans")
    paths = docs.select("doc_id", blob_of(F.col("text")).alias("blob"))
    spans = F.coalesce(F.col("spans"), F.expr("cast(array() as array<struct<start:int,kind_no:int,end:int>>)"))
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind_no"] == k)).cast("bigint")
    return paths.join(findings, "blob", "left").select(
        "doc_id",
        *(count(k).alias(f"n_{kind}") for k, (kind, _, _) in enumerate(RULES)),
        F.sha2(_listed(spans), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        F.col("blob"),
    )
