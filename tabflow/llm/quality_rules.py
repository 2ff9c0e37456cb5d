"""Quality rules: a threshold table compiled into one Spark projection of
length, symbol, stop-word and line ratios. Built-in functions only.

Edge cases: a null text has no words and no lines, so it fails the base rules;
an empty text likewise; an empty table gives an empty result; repeated rows
are judged one by one; a null or repeated doc_id changes nothing, as no step
joins or groups. Whole texts are measured, whatever their length. The stop-word
rule knows four languages: it has no say on rows of any other ``lang``, of none,
or of a table without that column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import NOT_SPACE, WHITE_SPACE, WORD_BREAK, documents

# Fixed values of the base measures.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
BASE_MIN_WORDS = 10
BASE_REPEAT_PERCENT = 20

STOP_WORD_MIN_WORDS = 40

# Frequent function words of LANGUAGES, matched as written here, capitalised and in capitals.
LANGUAGES = ("en", "de", "fr", "es")
STOP_WORDS = (
    "the and of to in a is that for it as was with be by on not he his are this at from or have an they which one you "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec "
    "el los del las por con no su para al lo como más pero sus este ya entre"
).split()
STOP_FORMS = list(dict.fromkeys(form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())))


@dataclass(frozen=True)
class Rule:
    """A document fails the rule if ``metric`` is below ``low`` or above ``high``."""

    metric: str
    low: float | None = None
    high: float | None = None


# The production threshold table. A ratio without a denominator is 0.
RULES: tuple[Rule, ...] = (
    Rule("mean_word_chars", low=1.5, high=20.0),
    Rule("symbol_ratio", high=0.15),
    Rule("exclamation_ratio", high=0.25),
    Rule("stop_word_ratio", low=0.02),
    Rule("dup_line_ratio", high=0.5),
)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _count_chars(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _windows(words: Column, join: Callable[..., Column]) -> Column:
    """``join`` of every WINDOW consecutive words. Words are taken by position:
    slice() inside the lambda would copy the whole array for each window."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: join(*[words[i + k] for k in range(WINDOW)])
    )


def _covered(pairs: Column) -> Column:
    """Words covered by windows that occur twice or more. ``pairs``: sorted
    (window, start) structs, so that equal windows are neighbours."""
    equal = F.zip_with(
        pairs,
        F.slice(pairs, 2, F.size(pairs)),
        lambda a, b: F.when(a["gram"] == b["gram"], F.array(a["at"], b["at"])).otherwise(F.array().cast("array<int>")),
    )
    starts = F.array_sort(F.array_distinct(F.flatten(equal)))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, at: F.struct(
            (acc["n"] + at + WINDOW - F.greatest(acc["end"], at)).alias("n"), (at + WINDOW).alias("end")
        ),
    )
    return covered["n"].cast("long")


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Distinct hashes of all windows prove that none repeats, the usual case.
    Otherwise the windows are compared as strings: words hold no space, so
    words joined by spaces are equal only if all words are."""
    windows = _windows(words, lambda *w: F.concat_ws(" ", *w))
    numbered = F.transform(windows, lambda gram, i: F.struct(gram.alias("gram"), i.alias("at")))
    exact = F.transform(F.array(F.sort_array(numbered)), _covered)[0]  # binds the sorted array once
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(exact)


def _known_language(docs: DataFrame, lang_col: str) -> Column:
    """Whether STOP_WORDS covers a row's language ("en", "EN" or "en-US")."""
    if lang_col not in docs.columns:
        return F.lit(False)
    code = F.lower(F.substring_index(F.col(f"`{lang_col}`").cast("string"), "-", 1))
    return F.coalesce(code.isin(*LANGUAGES), F.lit(False))


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_row: bool = False, lang_col: str = "lang"
) -> DataFrame:
    """doc_id, text and every metric a rule can name (and the input ``row``)."""
    df = documents(docs, id_col, text_col, whole_row, known=_known_language(docs, lang_col))
    df = df.withColumn("body", F.coalesce("text", F.lit("")))
    trimmed = F.trim(F.col("body"), F.lit(WHITE_SPACE))
    df = df.withColumn(
        "words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK))
    ).withColumn("lines", F.filter(F.split("body", "\n"), lambda line: line.rlike(NOT_SPACE)))
    n_words, n_lines = F.size("words"), F.size("lines")
    hashes = F.when(n_words < WINDOW, F.array().cast("array<long>")).otherwise(_windows(F.col("words"), F.xxhash64))
    kept = ["known", "row"] if whole_row else ["known", "text"]
    counts = {
        "n_words": n_words.cast("long"),
        "word_chars": F.length(F.translate("body", WHITE_SPACE, "")).cast("long"),
        "n_symbols": _count_chars(F.col("body"), SYMBOLS),
        "n_dup_lines": (n_lines - F.size(F.array_distinct("lines"))).cast("long"),
        "n_lines": n_lines.cast("long"),
        "n_stop_words": F.size(F.filter("words", lambda w: w.isin(*STOP_FORMS))).cast("long"),
        "n_exclamations": _count_chars(F.col("body"), "!"),
    }
    df = df.select("doc_id", *kept, "words", hashes.alias("hashes"), *[c.alias(k) for k, c in counts.items()])
    df = df.select("doc_id", *kept, *counts, _repeat_words(F.col("words"), F.col("hashes")).alias("n_repeat_words"))
    return df.withColumns(
        {
            "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
            "symbol_ratio": _ratio(F.col("n_symbols"), F.col("n_words")),
            "exclamation_ratio": _ratio(F.col("n_exclamations"), F.col("n_words")),
            # Null, which no rule rejects, for texts too short to be sure of a stop word and for other languages.
            "stop_word_ratio": F.when(
                F.col("known") & (F.col("n_words") >= STOP_WORD_MIN_WORDS), F.col("n_stop_words") / F.col("n_words")
            ),
            "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
            "repeat_ratio": _ratio(F.col("n_repeat_words"), F.col("n_words")),
        }
    ).drop("known")


def _fails(rule: Rule) -> Column:
    value, out = F.col(rule.metric), F.lit(False)
    if rule.low is not None:
        out = out | (value < F.lit(rule.low))
    if rule.high is not None:
        out = out | (value > F.lit(rule.high))
    return out


def _judge(measured: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    base_failed = (F.col("n_words") < BASE_MIN_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words")
    )
    verdicts = [F.when(_fails(r), F.lit(r.metric)) for r in rules] or [F.lit(None).cast("string")]
    # Always true, but not deterministic to the optimizer, so a filter on a verdict stays above the projection.
    # Pushed below it, the filter would repeat every measure, and the word split once for each window.
    once = F.spark_partition_id() >= 0
    return measured.withColumns(
        {"base_failed": base_failed & once, "failed": F.array_compact(F.array(*verdicts))}
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0) & once)


def quality_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text, all metrics, ``base_failed``, ``failed`` (the metrics whose
    rule rejects the document, in table order) and ``kept``."""
    return _judge(measure(docs, id_col, text_col), rules)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    judged = _judge(measure(docs, id_col, text_col, whole_row=True), rules)
    return judged.where("kept").select("row.*")
