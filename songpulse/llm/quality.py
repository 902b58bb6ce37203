"""Quality rules as a bitmask ledger (native): every rule once, policies and ablations later.

``ledger`` measures each document once and stores, per document, the measurements and one bit
per failed rule. A policy is a versioned mask of rules; applying another one, or asking what
one rule alone rejects, reads the ledger and never the texts again.

Defined cases: a NULL text is the empty text (no words, so it fails ``few_words``); a NULL
doc_id is kept as NULL; repeated rows are measured row by row; an empty table gives an empty
ledger; further columns of the input are ignored whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songpulse.llm.common import SPACES, has_word, n_chars, n_of, whole_text, without, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A rule's name and when it fails, over the measurement columns."""

    name: str
    fails: str


#: Bit i of ``fail_bits`` is rule i; append only, so that stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("upper_case", "100 * n_upper > 50 * word_chars"),
    Rule("exclamations", "100 * n_exclaims > 50 * n_words"),
    # Without the upper bound for texts in scripts that are written without spaces.
    Rule("word_length_spaced", "word_chars < 2 * n_words or word_chars > 20 * n_words and not unspaced"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
#: Policies by version: the mask of rules that reject a document.
_V2 = (1 << 7) - 1
POLICIES = {"base": BASE, "v1": BASE | BIT["symbols"], "v2": _V2, "v3": _V2 ^ BIT["word_length"] | BIT["word_length_spaced"]}
PRODUCTION = "v3"
#: Scripts that are written without spaces between words, as regex classes.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaims")


def with_measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, the measurements and ``unspaced``; one row per input row.

    ``unspaced``: whether words are longer than 20 characters on average and most letters are of a
    script without spaces. Only for such long words are the letters counted.

    Repeated windows are found on 64-bit hashes of eight words, inside the row: a long text
    costs a sort of its own windows and no shuffle.
    """
    rows = docs.select(*keep, whole_text().alias("_t"))
    rows = rows.select(
        *keep,
        F.transform(words(F.col("_t")), lambda w: F.xxhash64(w)).alias("_h"),
        F.filter(F.split("_t", "\n"), has_word).alias("_lines"),
        n_chars(without(F.col("_t"), SPACES)).alias("word_chars"),
        n_of(F.col("_t"), SYMBOLS).alias("n_symbols"),
        n_chars(F.regexp_replace("_t", "[^A-Z]+", "")).alias("n_upper"),
        n_of(F.col("_t"), "!").alias("n_exclaims"),
        "_t",
    )
    letters = lambda chars: n_chars(F.regexp_replace("_t", f"[^{chars}]+", ""))
    unspaced = 2 * letters(UNSPACED) > letters(r"\p{L}\p{M}")
    size = lambda c: F.size(c).cast("long")
    plain = ["word_chars", "n_symbols", "n_upper", "n_exclaims"]
    rows = rows.select(
        *keep,
        *plain,
        size("_h").alias("n_words"),
        size("_lines").alias("n_lines"),
        (size("_lines") - size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.when(F.size("_h") >= WINDOW, F.transform(
            F.slice("_h", F.lit(1), F.size("_h") - (WINDOW - 1)),
            lambda _, i: F.xxhash64(F.slice("_h", i + 1, WINDOW)),
        )).alias("_w"),
        F.when(F.col("word_chars") > 20 * size("_h"), unspaced).otherwise(F.lit(False)).alias("unspaced"),
    )
    plain += ["n_words", "n_lines", "n_dup_lines", "unspaced"]
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    pairs = F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.select(
        *keep,
        *plain,
        F.when(F.size(F.array_distinct("_w")) < F.size("_w"), F.sort_array(pairs)).otherwise(none).alias("_s"),
    )
    same = lambda e, other: F.coalesce(other["h"] == e["h"], F.lit(False))
    rows = rows.select(
        *keep,
        *plain,
        F.sort_array(F.transform(
            F.filter("_s", lambda e, j: same(e, F.get("_s", j - 1)) | same(e, F.get("_s", j + 1))),
            lambda e: e["i"],
        )).alias("_p"),
    )
    return rows.select(*keep, *plain, _covered(F.col("_p")).alias("n_repeat_words"))


def _covered(starts: Column) -> Column:
    """Words in the union of the windows at the ascending ``starts``."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        starts,
        zero,
        lambda a, p: F.struct((p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(a["end"], p)).alias("n")),
        lambda a: a["n"].cast("long"),
    )


def fail_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    """The bitmask of failed rules over the measurement columns."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def policy_bits(version: str) -> Column:
    """The failed rules of a ledger row that count under a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(POLICIES[version]).cast("long"))


def passes(mask: int) -> Column:
    """Whether a ledger row fails no rule of ``mask``."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")) == 0


def ledger(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default doc_id), the measurements, ``unspaced`` and ``fail_bits``; one row per document."""
    return with_measures(docs, keep or ["doc_id"]).withColumn("fail_bits", fail_bits())


def apply_policy(rows: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """Ledger rows with ``policy`` and ``kept`` under one policy version."""
    return rows.withColumns({"policy": F.lit(version), "kept": policy_bits(version) == 0})


def select_passing(docs: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """The documents that a policy keeps, with all their columns.

    The row rides through the measurement as one struct, so that no column name can clash, and comes
    out of a generator, so that no filter is pushed below (and evaluated twice over) the measurement.
    """
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("text"))
    rows = with_measures(row, ["_row"]).withColumn("fail_bits", fail_bits())
    return rows.select(F.inline(F.when(policy_bits(version) == 0, F.array("_row"))))


def ablation(rows: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone, and kept without it.

    One bitwise aggregation: the ledger is first counted per distinct bit pattern (at most
    2^rules rows), then each rule is switched off in the mask.
    """
    mask = POLICIES[version]
    patterns = rows.groupBy(policy_bits(version).alias("failed")).agg(F.count("*").alias("n"))
    rules = [(r.name, BIT[r.name]) for r in RULES if BIT[r.name] & mask]
    rule_rows = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in rules)))
    failed = F.col("failed")
    hit = failed.bitwiseAND(F.col("bit")) != 0
    return (
        patterns.select("failed", "n", rule_rows.alias("r"))
        .select("failed", "n", "r.*")
        .groupBy("rule", "bit")
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(failed == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(failed.bitwiseAND(F.bitwise_not("bit")) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )
