"""Quality rules: a table of thresholds compiled into one projection of built-in functions (operator 9).

Every measure of a document is an expression over its text; the verdict is the conjunction of the
rules. There is no user function, no shuffle and no row that meets another. Values that several
measures share are bound once, as the single element of an array under ``transform``.
Repeated 3-word windows are found by a 64-bit hash; where windows of one hash differ, by their words, so the count is exact.

Defined results: a null text counts as empty; an empty text has no words and fails. Repeated rows and
ids are judged each on its own. An empty table gives an empty result. Further columns pass ``filtered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Frequent short words of the languages served.
STOP_WORDS = sorted(set(
    "the of and to in is that it for on with as was by be are this from at or an have not"
    " der die und das ist nicht ein eine den mit von zu auf für im sich des dem"
    " le la les de des et un une en que qui dans pour sur du au par pas est"
    " el los las y del se una por con para no su al lo es".split()
))

#: Measure, least, most; None: no bound. A document must meet all.
RULES: list[tuple[str, float | None, float | None]] = [
    ("mean_word_length", 2.5, 12.0),
    ("symbols_per_word", None, 0.1),
    ("shouts_per_word", None, 0.2),
    ("capitals_per_letter", None, 0.5),
    ("stop_words_per_word", 0.02, None),
    ("dup_lines_per_line", None, 0.6),
]


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated(words: Column, n: Column, hashed=F.xxhash64) -> Column:
    """Words in 3-word windows that the text has twice or more.

    Windows are sorted by hash and place. If all neighbours of one hash have the same words, hashes tell windows apart; if not
    (a place of -1), the words themselves are sorted.
    """
    there = lambda i: [words[i + k] for k in range(3)]
    every = F.sequence(F.lit(0), n - 3)
    words_in = lambda at: F.size(F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(p, p + 1, p + 2)))))

    def marked(s: Column, key: str, differ=None) -> Column:
        same = lambda x, i: F.coalesce(F.get(s, i)[key] == x[key], F.lit(False))

        def place(x: Column, i: Column) -> Column:
            repeated = F.when(same(x, i - 1) | same(x, i + 1), x["i"])
            return F.when(same(x, i - 1) & differ(x, F.get(s, i - 1)), -1).otherwise(repeated) if differ else repeated

        return F.filter(F.transform(s, place), lambda p: p.isNotNull())

    def differ(x: Column, y: Column) -> Column:
        one, two, three = (a != b for a, b in zip(there(x["i"]), there(y["i"]), strict=True))
        return one | two | three

    by_words = F.sort_array(F.transform(every, lambda i: F.struct(F.array(*there(i)).alias("g"), i.alias("i"))))
    by_hash = F.sort_array(F.transform(every, lambda i: F.struct(hashed(*there(i)).alias("g"), i.alias("i"))))
    exact = lambda: let(by_words, lambda s: words_in(marked(s, "g")))
    count = let(by_hash, lambda s: let(marked(s, "g", differ), lambda at: F.when(F.array_contains(at, -1), exact()).otherwise(words_in(at))))
    return F.when(n >= 3, count).otherwise(0)


def measures(text: Column) -> Column:
    """A struct of all measures of ``text``."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(_without(x, BLANK)) != "")
    count = lambda cs, t: F.length(t) - F.length(_without(t, cs))
    upper = "".join(chr(c) for c in range(0x41, 0x17F) if chr(c).isupper())

    def of_words(w: Column) -> Column:
        return let(
            F.size(w),
            lambda n: F.struct(
                n.cast("long").alias("n_words"),
                _repeated(w, n).cast("long").alias("n_repeat_words"),
                F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            ),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    def whole(t: Column) -> Column:
        return F.struct(
            F.length(_without(t, BLANK)).cast("long").alias("word_chars"),
            count(SYMBOLS, t).cast("long").alias("n_symbols"),
            count("!", t).cast("long").alias("n_shouts"),
            count(upper, t).cast("long").alias("n_capitals"),
        )

    return F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("l"), let(text, whole).alias("t"))


def ratios(m: Column) -> dict[str, Column]:
    per = lambda a, b: a / F.greatest(b, F.lit(1).cast("long"))
    w, lines, t = m["w"], m["l"], m["t"]
    return {
        "mean_word_length": per(t["word_chars"], w["n_words"]),
        "symbols_per_word": per(t["n_symbols"], w["n_words"]),
        "shouts_per_word": per(t["n_shouts"], w["n_words"]),
        "capitals_per_letter": per(t["n_capitals"], t["word_chars"]),
        "stop_words_per_word": per(w["n_stop_words"], w["n_words"]),
        "dup_lines_per_line": per(lines["n_dup_lines"], lines["n_lines"]),
    }


def judged(text: Column, rules=RULES) -> Column:
    """A struct of the base measures, ``base_failed`` and ``kept``."""

    def verdict(m: Column) -> Column:
        failed = (m["w"]["n_words"] < 50) | (100 * m["w"]["n_repeat_words"] > 50 * m["w"]["n_words"])
        kept, by_name = ~failed, ratios(m)
        for name, least, most in rules:
            if least is not None:
                kept &= by_name[name] >= least
            if most is not None:
                kept &= by_name[name] <= most
        base = [m["w"]["n_words"], m["t"]["word_chars"], m["t"]["n_symbols"], m["l"]["n_dup_lines"], m["w"]["n_repeat_words"]]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        return F.struct(*[c.alias(n) for c, n in zip(base, names, strict=True)], failed.alias("base_failed"), kept.alias("kept"))

    return let(measures(text), verdict)


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """``doc_id``, the base measures, ``base_failed`` and ``kept``."""
    return docs.select("doc_id", judged(F.col("text"), rules).alias("_q")).select("doc_id", "_q.*")


def filtered(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns alone."""
    return docs.where(judged(F.col("text"), rules)["kept"])
