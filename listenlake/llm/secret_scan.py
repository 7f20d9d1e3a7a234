"""Secret scans: fixed patterns, and windows of high Shannon entropy over candidate strings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import stored

# The patterns of the base kinds, in their order; least lengths of what must be long.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # 18 characters or more of AKIA[A-Z0-9]+
HEX = r"[0-9a-f]{16,}"  # maximal runs, as the run before is never a digit of the kind
ASSIGN_LEAST = 12
KINDS = ["assign", "access", "hex", "entropy"]

WINDOW = 20
# A candidate is a run of key letters as long as a window at least, with its padding.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# By character class, bits of entropy that some window of a candidate must reach; twenty
# different characters have 4.32. Words of one case are no keys unless hardly a letter repeats.
CLASSES = [
    (r"^[0-9a-f]+$", 2.9),
    (r"^([a-z]+|[A-Z]+|[A-Z]?[a-z]+)$", 4.25),
    (r"^[A-Za-z0-9]+=*$", 3.6),
]
OTHER_CLASS = 3.8
# Harmless strings of high entropy: numbers, rulers, UUIDs, dates, and what is made to be replaced.
ALLOWED = [
    r"^[0-9]+$",
    r"^[+/_=-]+$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[0-9_-]*$",
    r"(?i)example|placeholder|changeme|dummy|your_|xxxx|abcdefgh|01234567",
]

def _spans(text: Column, pattern: str, kind: int, least: tuple[int, int] | None = None) -> Column:
    """Matches of ``pattern`` as an array of (start, kind, end, match) in code points.

    What lies between the matches gives their places. ``least`` is a group and its least length.
    """
    between = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    size = F.transform(found, F.length)
    # (gap before, match, length, long enough) of each match, in turn.
    long_enough = (
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(least[0])), lambda g: F.length(g) >= least[1])
        if least
        else F.transform(found, lambda _: F.lit(True))
    )
    rows = F.arrays_zip(
        F.slice(between, 1, F.size(found)).alias("gap"), found.alias("match"), size.alias("n"), long_enough.alias("ok")
    )
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")
    folded = F.aggregate(
        rows,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, m: F.struct(
            (acc["at"] + m["gap"] + m["n"]).alias("at"),
            F.when(
                m["ok"],
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + m["gap"]).alias("start"),
                            F.lit(kind).alias("kind"),
                            (acc["at"] + m["gap"] + m["n"]).alias("end"),
                            m["match"].alias("match"),
                        )
                    ),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
    )["out"]
    return F.when(text.rlike(pattern), folded).otherwise(empty)


def _n_log_n(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n)).otherwise(F.lit(0.0))


def window_entropy(text: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits, of any window of ``text``; of key letters, at least one window long.

    The window slides by one character at a time: the counts of the character that enters and
    of the one that leaves change, and with them two terms of the sum. Both are counted in the
    window that is carried along, so that a character costs the same in a text of any length.
    """
    start = F.struct(F.lit("").alias("window"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def occurrences(letters: Column, letter: Column) -> Column:
        return window - F.length(F.replace(F.rpad(letters, F.lit(window), F.lit(" ")), letter, F.lit("")))

    def slide(acc: Column, enters: Column) -> Column:
        full = F.length(acc["window"]) == window
        leaves = F.substring(acc["window"], 1, 1)
        more, less = occurrences(acc["window"], enters), occurrences(acc["window"], leaves)
        grown = _n_log_n(more + 1) - _n_log_n(more)
        change = (
            F.when(~full, grown)
            .when(leaves != enters, grown + _n_log_n(less - 1) - _n_log_n(less))
            .otherwise(F.lit(0.0))
        )
        total = acc["sum"] + change
        moved = F.concat(F.when(full, F.substring(acc["window"], 2, window - 1)).otherwise(acc["window"]), enters)
        entropy = F.when(F.length(moved) == window, F.log2(F.lit(float(window))) - total / window).otherwise(F.lit(0.0))
        return F.struct(moved.alias("window"), total.alias("sum"), F.greatest(acc["best"], entropy).alias("best"))

    letters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.aggregate(letters, start, slide, lambda acc: acc["best"])


def _is_secret(match: Column) -> Column:
    threshold = F.lit(OTHER_CLASS)
    for pattern, bits in reversed(CLASSES):
        threshold = F.when(match.rlike(pattern), F.lit(bits)).otherwise(threshold)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | match.rlike(pattern)
    return ~allowed & (window_entropy(match) >= threshold)


def _of_kind(kind: int) -> Callable[[Column], Column]:
    # One parameter: given two, Spark would pass the place in the array as the second.
    return lambda span: span["kind"] == kind


def _shown(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def secret_spans(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with ``base`` and ``extra``: spans (start, kind, end, match), by start and kind.

    Base spans are the matches of the three fixed patterns, leftmost and not overlapping within
    a kind. Extra ones are candidate strings some window of which reaches the entropy of their
    character class, unless the allow-list knows them or a base span already covers or crosses
    them. Whole texts are scanned; null counts as empty. Rows are independent of each other:
    repeated rows and rows without id give one row each. Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(
        "doc_id",
        F.concat(
            _spans(text, ASSIGN, 0, (2, ASSIGN_LEAST)), _spans(text, ACCESS, 1), _spans(text, HEX, 2)
        ).alias("base"),
        _spans(text, CANDIDATE, 3).alias("candidates"),
    )
    # Written here, so that no text is scanned twice for columns that are used twice below.
    found = stored(found.withColumn("base", F.array_sort("base")), "candidates")
    base = F.col("base")
    apart = F.filter(
        "candidates", lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    )
    return found.select("doc_id", "base", F.filter(apart, lambda c: _is_secret(c["match"])).alias("extra"))


def scan_report(docs: DataFrame) -> DataFrame:
    """Counts and places of secrets: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = secret_spans(docs)
    count = [F.size(F.filter("base", _of_kind(kind))).cast("long").alias(f"n_{KINDS[kind]}") for kind in range(3)]
    every = F.array_sort(F.concat("base", "extra"))
    return found.select("doc_id", *count, F.sha2(_shown(F.col("base")), 256).alias("base_sha256"), _shown(every).alias("spans"))
