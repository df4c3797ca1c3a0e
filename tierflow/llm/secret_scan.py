"""Secret scan over an incremental blob ledger.

Every text is a version of a file: its SHA-256 is its address, so equal texts of
any number of paths are one blob.  The ledger is an append-only Parquet table of
``blob, rules, found``: the rule versions that a scan applied to the blob, and
the spans they found.  A scan

1. groups the given texts by address (equal texts meet before the shuffle),
2. leaves out what the ledger has: a blob is scanned only with the rule versions
   that it has not seen yet, so a new version of one rule rereads no other rule,
3. appends one ledger row for each blob that it scanned, also where it found
   nothing, and
4. ``findings_by_path`` joins the spans back to every path with that address.

A span is a match of its rule in code points, end exclusive.  Matches are found
without user functions: each one is put between marks, the text is split at them
and the lengths of the pieces are summed up, so a text costs time in proportion
to its length.  The mark is U+0001; in the text it is first replaced by U+0002,
which no rule can tell from it.

Defined results: a null text is the empty text; empty texts have no spans;
repeated rows and rows with equal or null paths each keep their row; columns
other than the path and the text are not used, so their names do not matter; an
empty table gives an empty result and an empty increment.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.llm.common import read
from tierflow.session import work_dir
from tierflow.sinks.paths import list_dirs

MARK, STAND_IN = "\x01", "\x02"
NO_SPANS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of the empty text
LEDGER = ("blob string, rules array<string>, "
          "found array<struct<rule: string, version: int, start: int, end: int>>, increment int")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """``pattern`` holds in Java's and RE2's syntax; a match counts if ``group`` of
    it has ``least`` characters.  ``needs``: texts that any match contains.  A rule
    that changes gets a new ``version``."""

    name: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1
    needs: tuple[str, ...] = ()

    @property
    def id(self) -> str:
        return f"{self.name}@{self.version}"


_KEYS = "|".join([_either_case("password"), _either_case("passwd"), _either_case("secret"), _either_case("token"),
                  _either_case("api") + "_?" + _either_case("key")])
# The first three are the base: their order and spans are fixed.  A run of hex digits or of an
# access key is one match, so a least length can stand in the pattern; a value that is too short
# uses up its text, so that length is checked after the match.
BASE = (
    Rule("assign", rf"({_KEYS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", needs=("AKIA",)),
    Rule("hex", r"[0-9a-f]{32,}"),
)
RULES = (
    *BASE,
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", needs=("PRIVATE KEY-----",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", needs=("gh",)),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", needs=("xox",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs=("eyJ",)),
    Rule("userinfo", r"://[^\x00-\x20/@:]{1,64}:[^\x00-\x20/@:]{6,128}@", needs=("://", "@")),
)


def address(text: Column) -> Column:
    """The content address of a text (null: of the empty text)."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class BlobLedger:
    """The ledger in the folder ``path`` (shared by driver and executors)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def increments(self) -> list[int]:
        return sorted(int(d.partition("=")[2]) for d in list_dirs(self.path) if d.startswith("increment="))

    def read(self) -> DataFrame:
        if not self.increments():
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def unseen(self, versions: DataFrame, rules: Sequence[Rule], text_col: str = "text") -> DataFrame:
        """``blob, text, todo``: every distinct text of ``versions`` with the rules that
        the ledger does not have for it; blobs with none are left out."""
        text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
        blobs = versions.select(address(text).alias("blob"), text.alias("text")).groupBy("blob").agg(
            F.first("text").alias("text"))
        wanted = F.array(*[F.lit(r.id) for r in rules])
        if not self.increments():
            return blobs.withColumn("todo", wanted)
        seen = self.read().groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
        todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        return (blobs.join(seen, "blob", "left").select("blob", "text", todo.alias("todo"))
                .filter(F.size("todo") > 0))

    def scan(self, versions: DataFrame, increment: int, rules: Sequence[Rule] = RULES, text_col: str = "text") -> None:
        """Scan what is new in ``versions`` and append it as ``increment``.  A repeated
        run of the last increment replaces it; earlier ones cannot be replaced."""
        have = self.increments()
        if have and increment < have[-1]:
            raise ValueError(f"increment {increment} is older than {have[-1]}")
        before = BlobLedger(self.spark, self.path)
        if increment in have:  # a replay: decide by the ledger as it was before
            before.increments = lambda: [i for i in have if i < increment]
            before.read = lambda: self.read().filter(F.col("increment") < increment)
        spans(before.unseen(versions, rules, text_col), rules).write.mode("overwrite").parquet(
            f"{self.path}/increment={increment}")

    def findings(self, rules: Sequence[Rule] = RULES) -> DataFrame:
        """``blob, found`` of the blobs with a span of these rule versions; ``found`` is
        sorted by start and then by the order of the rules."""
        rank = F.array(*[F.lit(r.id) for r in rules])
        place = lambda s: F.array_position(rank, F.concat(s["rule"], F.lit("@"), s["version"].cast("string")))
        one = F.transform("found", lambda s: F.struct(
            s["start"].alias("start"), place(s).cast("int").alias("rank"), s["end"].alias("end"), s["rule"].alias("rule")))
        return (self.read().filter(F.size("found") > 0)
                .select("blob", F.filter(one, lambda s: s["rank"] > 0).alias("found"))
                .groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
                .filter(F.size("found") > 0))

    def findings_by_path(self, versions: DataFrame, path_col: str, rules: Sequence[Rule] = RULES,
                         text_col: str = "text") -> DataFrame:
        """One row for each row of ``versions``: its path, its blob and the spans of the
        blob (an empty array where there are none)."""
        found = self.findings(rules)
        paths = versions.select(F.col(f"`{path_col}`").alias("path"), address(F.col(f"`{text_col}`")).alias("blob"))
        none = F.array().cast(found.schema["found"].dataType)
        return paths.join(found, "blob", "left").select("path", "blob", F.coalesce("found", none).alias("found"))


def spans(blobs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Ledger rows of ``blobs(blob, text, todo)``: every rule named in ``todo`` is
    applied to the whole text."""
    text = F.translate("text", MARK, STAND_IN)

    def pieces(rank: int, r: Rule) -> Column:
        hit = F.array_contains("todo", r.id)
        for needed in r.needs:
            hit &= F.contains("clean", F.lit(needed))
        hit &= F.col("clean").rlike(r.pattern)
        marked = F.regexp_replace("clean", r.pattern, f"{MARK}$0{MARK}")
        return F.struct(F.lit(rank).alias("rank"), F.when(hit, F.split(marked, MARK)).alias("pieces"))

    scanned = blobs.select("blob", "todo", text.alias("clean")).select(
        "blob", "todo", F.filter(F.array(*[pieces(k, r) for k, r in enumerate(rules)]),
                                 lambda s: s["pieces"].isNotNull()).alias("hits"))
    by_rule = scanned.select("blob", "todo", F.explode_outer("hits").alias("hit"))
    piece = by_rule.select("blob", "todo", F.col("hit.rank").alias("rank"),
                           F.posexplode_outer("hit.pieces").alias("pos", "piece"))
    good = F.lit(False)  # odd pieces are the matches
    for k, r in enumerate(rules):
        value = F.regexp_extract("piece", r.pattern, r.group) if r.group else F.col("piece")
        good = F.when(F.col("rank") == k, F.length(value) >= r.least).otherwise(good)
    rows = piece.select("blob", "todo", "rank", "pos", F.length("piece").alias("len"),
                        F.when(F.col("pos") % 2 == 1, good).otherwise(F.lit(False)).alias("good"))
    # the addresses are dealt already: a running sum over the pieces of one text, no shuffle
    ends = F.sum("len").over(Window.partitionBy("blob", "rank").orderBy("pos")
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("end", ends.cast("int"))
    names = F.array(*[F.lit(r.name) for r in rules])
    versions = F.array(*[F.lit(r.version) for r in rules])
    span = F.struct(F.element_at(names, F.col("rank") + 1).alias("rule"),
                    F.element_at(versions, F.col("rank") + 1).alias("version"),
                    (F.col("end") - F.col("len")).cast("int").alias("start"), F.col("end").alias("end"))
    return rows.groupBy("blob").agg(F.first("todo").alias("rules"),
                                    F.collect_list(F.when(F.col("good"), span)).alias("found"))


def digest(found: Column) -> Column:
    """``rule:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as versions of the path ``doc_id``, over a new ledger."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = BlobLedger(spark, work_dir(spark, "blob-ledger"))
    ledger.scan(docs, 0)
    by_path = ledger.findings_by_path(docs, "doc_id")
    base = F.filter("found", lambda s: s["rank"] <= len(BASE))
    count = lambda rank: F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long")
    return by_path.select(
        F.col("path").alias("doc_id"), *[count(k + 1).alias(f"n_{r.name}") for k, r in enumerate(BASE)],
        F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("found")).alias("spans"))


def _sql() -> str:
    parts = []
    for k, r in enumerate(RULES, 1):
        p = r.pattern.replace("'", "''")
        value = f"regexp_extract(piece, '{p}', {r.group})" if r.group else "piece"
        parts.append(f"""SELECT r, {k} AS rank, '{r.name}' AS kind, pos, length(piece) AS len,
       pos % 2 = 1 AND length({value}) >= {r.least} AS good
FROM (SELECT r, unnest(p) AS piece, unnest(range(len(p))) AS pos
      FROM (SELECT r, string_split(regexp_replace(x, '{p}', chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS p
            FROM t WHERE regexp_matches(x, '{p}')))""")
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), chr(1), chr(2)) AS x FROM documents),
pieces AS ({' UNION ALL '.join(parts)}),
placed AS (SELECT *, sum(len) OVER (PARTITION BY r, rank ORDER BY pos) AS stop FROM pieces),
spans AS (SELECT r, rank, kind, stop - len AS start, kind || ':' || (stop - len)::BIGINT || ':' || stop::BIGINT AS span
          FROM placed WHERE good),
found AS (SELECT r, count(*) FILTER (rank = 1) AS n_assign, count(*) FILTER (rank = 2) AS n_access,
                 count(*) FILTER (rank = 3) AS n_hex,
                 string_agg(span, ',' ORDER BY start, rank) FILTER (rank <= {len(BASE)}) AS base,
                 string_agg(span, ',' ORDER BY start, rank) AS spans
          FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN found USING (r)
"""


QUERIES = {"op11_secret_scan": op11_secret_scan}
ORACLES = {"op11_secret_scan": _sql()}
