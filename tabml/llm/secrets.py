"""Secret scans with an incremental blob ledger, in DataFrame expressions only.

Every version of every path is addressed by the SHA-256 of its content. The ledger, a
Parquet table (blob, rules, found), holds which rules have scanned which blob, and what they
found. A run scans only the (blob, rule version) pairs the ledger lacks, appends them,
and joins the findings back to all paths. A rule's version is a digest of its pattern, so
a changed or new rule scans every blob again, and only that rule does.

Only keys and digests are grouped; the text of a blob is read from one representative
row, however many paths share it. Appends are committed as a whole, so a lost run leaves
nothing behind, and a blob scanned twice gives the same findings once.

Positions are code points, the end is exclusive. Matches of one rule are the leftmost that
don't overlap; matches that fail the rule's length test are dropped afterwards.

Results for odd input: texts of any length are scanned whole; a NULL text is the empty blob, without findings; rows with NULL or
repeated keys give one row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm.frames import empty_table, free_name, quoted
from tabml.session import new_path, staged

# Two characters that mark matches; where a text has them, another that no rule accepts
# stands in their place while it is searched.
_OPEN, _CLOSE, _OTHER = "\u0001", "\u0002", "\u0003"
_SPANS = "array<struct<start:int,place:int,end:int,kind:string,rule:string>>"
LEDGER_SCHEMA = f"blob string, rules array<string>, found {_SPANS}"


@dataclass(frozen=True)
class Rule:
    """``keeps`` tells from the matched string whether the match counts."""

    kind: str
    pattern: str
    least: int = 0  # least length of the match, or of ``group``
    group: int = 0

    def keeps(self, match: Column) -> Column:
        if not self.least:
            return F.lit(True)
        part = F.regexp_extract(match, self.pattern, self.group) if self.group else match
        return F.char_length(part) >= self.least

    @property
    def version(self) -> str:
        text = f"{self.kind} {self.pattern} {self.least} {self.group}"
        return f"{self.kind}@{hashlib.sha256(text.encode()).hexdigest()[:12]}"


BASE = [
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # the same as runs of any length, short ones dropped
]
# A private key: its first line and what follows up to its last one, whatever dashes lie between; where that is
# missing, the base64 block, which may be indented, quoted, escaped or on one line, and a word or two after it, as
# a block's last line may be short. Repeats are possessive: no bound on the lines, and no stack that grows with them.
_KEY_BEGIN = r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"
_KEY_TO_END = r"(?:[^-]++|-(?!-{4}))*+-{5,}+END (?:[A-Z]+ )*PRIVATE KEY-----"
_GAP = r"""[\x20\t\r\n\\"',>|#*+]"""
_LINES = r"[A-Za-z0-9+/]{16}" + r"""[A-Za-z0-9+/=\r\n\\"',]*"""  # 16 characters at least
_KEY_BLOCK = (
    rf"""{_GAP}*(?:[A-Za-z][A-Za-z-]*:\x20?[^\x20\t\r\n\\"']+{_GAP}+){{0,8}}"""
    rf"{_LINES}(?:{_GAP}+{_LINES})*+(?:{_GAP}+[A-Za-z0-9+/]+={{0,2}})?"
)
# Public formats of common credentials.
FORMATS = [
    Rule("private_key", _KEY_BEGIN + f"(?:{_KEY_TO_END}|{_KEY_BLOCK})?"),
    Rule("json_web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
]
RULES = [*BASE, *FORMATS]


def spans(text: Column, rule: Rule, place: int) -> Column:
    """The rule's findings in a text as an array, in order of position."""
    plain = F.translate(text, _OPEN + _CLOSE, _OTHER + _OTHER)
    # Plain stretches and matches in turn.
    parts = F.split(F.regexp_replace(plain, rule.pattern, f"{_OPEN}$0{_CLOSE}"), f"[{_OPEN}{_CLOSE}]")
    empty = F.from_json(F.lit("[]"), _SPANS)

    def step(state: Column, part: Column) -> Column:
        end = state["at"] + F.char_length(part)
        span = F.struct(
            state["at"].alias("start"),
            F.lit(place).alias("place"),
            end.alias("end"),
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("rule"),
        )
        found = F.when(state["inside"] & rule.keeps(part), F.concat(state["found"], F.array(span)))
        return F.struct(
            end.alias("at"), (~state["inside"]).alias("inside"), found.otherwise(state["found"]).alias("found")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), empty.alias("found"))
    return F.when(text.rlike(rule.pattern), F.aggregate(parts, start, step, lambda s: s["found"])).otherwise(empty)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per blob: all rules that scanned it and all findings; empty before the first append."""
    try:
        rows = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except (AnalysisException, Py4JJavaError):
        rows = empty_table(spark, LEDGER_SCHEMA)
    flat: Callable[[str], Column] = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    return rows.groupBy("blob").agg(flat("rules").alias("rules"), flat("found").alias("found"))


_SMALL = 200_000  # spans that may be broadcast: about 60 bytes each


def _small(hits: DataFrame) -> DataFrame:
    """``hits`` marked for broadcast if they hold few spans, else as they are."""
    total = hits.agg(F.coalesce(F.sum(F.size("found")), F.lit(0))).first()[0]
    return F.broadcast(hits) if total <= _SMALL else hits


def scan(
    versions: DataFrame,
    ledger: str | None = None,
    rules: list[Rule] = RULES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, blob, found) for each row; ``found`` is sorted by start, then order of the rules."""
    spark = versions.sparkSession
    ledger = ledger or new_path(spark, "secret-ledger")
    wanted = F.array(*[F.lit(r.version) for r in rules])
    content = F.coalesce(F.col(text), F.lit(""))
    rows = versions.select(
        F.col(key).alias("key"),
        # Never NULL: the join below has to find the representative row.
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null")).alias("row"),
        content.alias("text"),
        F.sha2(content, 256).alias("blob"),
    )
    keys = staged(rows.drop("text"), "blob-keys")
    seen = staged(read_ledger(spark, ledger).select("blob", "rules"), "blobs-seen")
    first = keys.groupBy("blob").agg(F.min("row").alias("row")).join(seen, "blob", "left")
    open_ = F.array_except(wanted, F.coalesce("rules", F.array().cast("array<string>")))
    unseen = first.select("blob", "row", open_.alias("rules")).filter(F.size("rules") > 0)

    texts = rows.select("blob", "row", "text").join(unseen, ["blob", "row"])
    empty = F.from_json(F.lit("[]"), _SPANS)
    each = [
        F.when(F.array_contains("rules", r.version), spans(F.col("text"), r, i)).otherwise(empty)
        for i, r in enumerate(rules)
    ]
    texts.select("blob", "rules", F.concat(*each).alias("found")).write.mode("append").parquet(ledger)

    known = read_ledger(spark, ledger)
    current = F.array_sort(F.filter("found", lambda f: F.array_contains(wanted, f["rule"])))
    # Most blobs hold nothing: only the others have to meet their paths.
    hits = known.select("blob", current.alias("found")).filter(F.size("found") > 0)
    joined = keys.join(_small(staged(hits, "blobs-with-secrets")), "blob", "left")
    return joined.select(F.col("key").alias(key), "blob", F.coalesce("found", empty).alias("found"))


def listed(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans merge."""

    def step(state: Column, f: Column) -> Column:
        begin = F.greatest(f["start"], state["at"])
        cut = F.concat(state["out"], F.substring(text, state["at"] + 1, begin - state["at"]))
        joined = F.when(f["start"] < state["at"], state["out"]).otherwise(F.concat(cut, F.lit("["), f["kind"], F.lit("]")))
        return F.struct(joined.alias("out"), F.greatest(f["end"], state["at"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    rest = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text)))
    return F.when(F.size(found) > 0, F.aggregate(found, start, step, rest)).otherwise(text)


def redact(docs: DataFrame, ledger: str | None = None, rules: list[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the spans found in their texts replaced by the rule's kind; NULL texts stay NULL."""
    blob, found = free_name("_blob", docs.columns), free_name("_found", docs.columns)
    hits = scan(docs, ledger, rules, key, text).filter(F.size("found") > 0)
    # Copies have the same findings: one row per blob.
    hits = _small(staged(hits.groupBy("blob").agg(F.min("found").alias("found")), "redactions"))
    hits = hits.select(F.col("blob").alias(blob), F.col("found").alias(found))
    rows = docs.withColumn(blob, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    rows = rows.join(hits, blob, "left")
    clean = F.when(F.col(found).isNull(), F.col(text)).otherwise(redacted(F.col(text), F.col(found)))
    return rows.withColumn(text, clean).select(*quoted(docs.columns))
