"""Operator 3, quality rules with a bitmask ledger; DataFrame functions only.

``measure`` reads each text once and gives the measurements.  ``ledger``
evaluates every rule once over them and stores the failures as one bit each.
Policies are versioned sets of rules (``POLICIES``); applying one is a bitwise
AND with the ledger, and ``ablations`` gets, from bitwise aggregation alone,
what each rule rejects, rejects alone and adds to a policy, without a text
being read again.

Defined cases: null text has no words, no lines and fails ``few_words``;
repeated rows are judged as rows; a null id stays null; an empty table gives
an empty ledger; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = " \t\n\x0b\f\r"
#: Windows of a text whose places fit into the low bits of a hash.
_PLACES = 1 << 21

#: name -> failing condition over the measurements; the bit of a rule is its
#: place.  New rules go to the end so that stored ledgers keep their meaning.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "many_symbols": "10 * n_symbols > 3 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "short_words": "word_chars < n_words + n_words div 2",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "shouting": "2 * n_upper > word_chars and word_chars >= 40",
}

#: Versioned policies: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "web-1": ("few_words", "repeated_words", "many_symbols", "long_words", "short_words", "repeated_lines", "shouting"),
}


def mask_of(policy: str) -> int:
    return sum(1 << i for i, name in enumerate(RULES) if name in POLICIES[policy])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_upper of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"))
    words = F.split(F.btrim("t", F.lit(_SPACE)), "[\\x20\\x09-\\x0D]+")
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(_SPACE)) != "")
    count = lambda pattern: F.regexp_count("t", F.lit(pattern)).cast("long")
    src = src.select("doc_id", F.length("t").cast("long").alias("n_chars"), count("[\\x20\\x09-\\x0D]").alias("n_spaces"), count("[#*$%&|<>]").alias("n_symbols"), count("[A-Z]").alias("n_upper"),
                     F.transform(words, lambda w: F.xxhash64(w)).alias("h"), lines.alias("lines"))
    src = src.withColumn("word_chars", F.col("n_chars") - F.col("n_spaces")).withColumn("h", F.when(F.col("word_chars") > 0, F.col("h")).otherwise(F.array().cast("array<bigint>")))
    # a hash for each window of five words, by its place
    windows = F.when(F.size("h") >= 5, F.transform(F.sequence(F.lit(0), F.size("h") - 5), lambda i: F.xxhash64(*(F.get("h", i + k) for k in range(5))))).otherwise(F.array().cast("array<bigint>"))
    src = src.withColumn("w", windows)
    src = src.withColumn("repeats", F.size(F.array_distinct("w")) < F.size("w"))
    # only texts with a repeat: sort the windows by hash, find those equal to a neighbour, put their places in order.
    # The place is packed into the low bits, so that plain numbers are sorted; a text with more windows than that sorts pairs
    place, top = F.lit(_PLACES - 1).cast("long"), F.lit(-_PLACES).cast("long")
    packed = F.sort_array(F.transform("w", lambda x, i: x.bitwiseAND(top).bitwiseOR(i.cast("long"))))
    same = lambda x, y: x.bitwiseXOR(y).bitwiseAND(top) == 0
    alike = F.filter("s", lambda x, j: _any([same(x, F.get("s", j - 1)), same(x, F.get("s", j + 1))]))
    at = lambda x: F.get("w", x.bitwiseAND(place).cast("int"))
    near = F.transform("c", lambda x, j: F.when(_any([at(x) == at(F.get("c", j + d)) for d in (-2, -1, 1, 2)]), x.bitwiseAND(place).cast("int")))
    pairs = F.array_sort(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    near_pairs = F.transform("s2", lambda x, j: F.when(_any([x.x == F.get("s2", j + d).x for d in (-1, 1)]), x.i))
    small = F.size("w") < _PLACES
    src = src.withColumn("s", F.when(F.col("repeats") & small, packed)).withColumn("s2", F.when(F.col("repeats") & ~small, pairs))
    src = src.withColumn("c", alike)
    src = src.withColumn("p", F.sort_array(F.array_compact(F.when(small, near).otherwise(near_pairs))))
    covered = F.aggregate(F.transform("p", lambda x, j: F.least(F.lit(5), F.coalesce(F.get("p", j + 1) - x, F.lit(5)))), F.lit(0), lambda a, x: a + x)
    # one generated row: a filter on a measurement stays above it, so it never repeats the expressions behind the others
    return src.select("doc_id", F.inline(F.array(F.struct(
        F.size("h").cast("long").alias("n_words"), F.col("word_chars"), F.col("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), F.col("n_upper")))))


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | F.coalesce(c, F.lit(False))
    return F.coalesce(out, F.lit(False))


def ledger(measured: DataFrame) -> DataFrame:
    """The measurements and ``failed``, a bitmask with one bit per rule."""
    bits = [F.when(F.coalesce(F.expr(cond), F.lit(False)), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, cond in enumerate(RULES.values())]
    mask: Column = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return measured.withColumn("failed", mask)


def apply_policy(stored: DataFrame, policy: str) -> DataFrame:
    """Adds ``rejected_by`` (the policy's failing bits) and ``kept``."""
    hit = F.col("failed").bitwiseAND(F.lit(mask_of(policy)))
    return stored.withColumn("rejected_by", hit).withColumn("kept", hit == 0)


def ablations(stored: DataFrame, policy: str) -> DataFrame:
    """One row per rule of the policy: rows it fails, rows that it alone
    rejects (kept if the rule were dropped), rows the policy rejects."""
    hit = F.col("failed").bitwiseAND(F.lit(mask_of(policy)))
    by_mask = stored.groupBy(hit.alias("m")).agg(F.count("*").alias("n"))  # at most 2 ** rules rows
    rules = [(name, 1 << i) for i, name in enumerate(RULES) if name in POLICIES[policy]]
    cols = [F.struct(F.lit(name).alias("rule"),
                     F.coalesce(F.sum(F.when(F.col("m").bitwiseAND(F.lit(bit)) != 0, F.col("n"))), F.lit(0)).alias("n_failed"),
                     F.coalesce(F.sum(F.when(F.col("m") == bit, F.col("n"))), F.lit(0)).alias("n_only"),
                     F.coalesce(F.sum(F.when(F.col("m") != 0, F.col("n"))), F.lit(0)).alias("n_rejected")) for name, bit in rules]
    return by_mask.agg(F.array(*cols).alias("r")).select(F.explode("r").alias("r")).select("r.*")
