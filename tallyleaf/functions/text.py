"""Cleaning and shingling of notice texts, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording the portals wrap around a notice.
PREAMBLE_END = "NOTICE DETAILS FOLLOW"
PREAMBLE_RULE = "=" * 79
FOOTER_RULE = "-" * 79
TRUNCATION_MARK = "[entry truncated"
DASH_RUN = r"-{10,}\s*"
TITLE_PREFIXES = r"(?i)^(?:(?:nit for|e-tender\s*-?|tender notice:?|corrigendum\s*-?)\s*|\s+)+"
TITLE_REFERENCE = r"(?i)\[[a-z0-9/_-]+\]"
REFERENCE_LINE = r"(?i)tender reference number:[^\n]+"
DATE_PATTERNS = (
    r"\b\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}\b",
    r"\b\d{4}[-/.]\d{1,2}[-/.]\d{1,2}\b",
    r"(?i)\b\d{1,2}\s+(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+\d{2,4}\b",
)
# What stands between words.
NOT_ALPHANUMERIC = "[^a-z0-9]+"
BLANKS = "[\\t-\\r\\x1c-\\x20\\x{85}\\p{Z}]+"


def _words_only(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), NOT_ALPHANUMERIC, " "))


def _joined(title, body) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))


def raw_text(title: Column, body: Column) -> Column:
    """Title and body in lower case, nothing removed."""
    return F.lower(_joined(title, body))


def raw_words(title: Column, body: Column) -> Column:
    """The raw text's words, one blank apart."""
    return single_blanks(raw_text(title, body))


def single_blanks(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def naive_text(title: Column, body: Column) -> Column:
    """Lower case, letters and digits only, boilerplate kept."""
    return _words_only(_joined(title, body))


def _after_preamble(body: Column) -> Column:
    tail = body.substr(F.locate(PREAMBLE_END, body), F.length(body))
    rest = F.when(
        F.regexp_like(tail, F.lit(DASH_RUN)), F.regexp_replace(tail, "(?s)^.*?" + DASH_RUN, "")
    ).otherwise(tail.substr(F.lit(len(PREAMBLE_END) + 1), F.length(tail)))
    after_rule = body.substr(F.locate(PREAMBLE_RULE, body) + len(PREAMBLE_RULE), F.length(body))
    return (
        F.when(F.contains(body, F.lit(PREAMBLE_END)), rest)
        .when(F.contains(body, F.lit(PREAMBLE_RULE)), after_rule)
        .otherwise(body)
    )


def processed_text(title: Column, body: Column) -> Column:
    """The notice itself: preamble, footer, title wrapping, reference lines and dates removed."""
    text = _after_preamble(F.coalesce(body, F.lit("")))
    text = F.substring_index(text, FOOTER_RULE, 1)
    text = F.substring_index(text, TRUNCATION_MARK, 1)
    head = F.regexp_replace(F.coalesce(title, F.lit("")), TITLE_PREFIXES, "")
    head = F.regexp_replace(head, TITLE_REFERENCE, "")
    full = F.regexp_replace(F.concat(head, F.lit(" "), text), REFERENCE_LINE, "")
    for pattern in DATE_PATTERNS:
        full = F.regexp_replace(full, pattern, "")
    return _words_only(full)


def words(text: Column) -> Column:
    """Tokens of a text whose blanks are already single spaces; none for an empty text."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def word_ngrams(text: Column, n: int) -> Column:
    """Distinct word n-grams; a text of fewer than n words gives its words.

    The look-ahead lets matches overlap, so one regex pass lists every n-gram.
    """
    if n == 1:
        return F.array_distinct(words(text))
    gram = "[^ ]+" + " [^ ]+" * (n - 1)
    grams = F.regexp_extract_all(text, F.lit(f"(?:^| )(?=({gram}))"), F.lit(1))
    few = F.size(F.split(text, " ", n)) < n
    return F.array_distinct(F.when(few, words(text)).otherwise(grams))


def char_ngrams(text: Column, n: int = 5) -> Column:
    """Distinct character n-grams; a shorter text is its own single shingle."""
    grams = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
    return F.array_distinct(F.when(F.length(text) < n, F.array(text)).otherwise(grams))


def common_prefix(a: Column, b: Column) -> Column:
    """Longest common prefix, by bisection on its length (31 comparisons, whatever the length)."""
    start = F.struct(F.lit(0).alias("lo"), F.least(F.length(a), F.length(b)).alias("hi"))

    def halve(span, _):
        mid = F.floor((span["lo"] + span["hi"] + 1) / 2).cast("int")
        same = F.left(a, mid) == F.left(b, mid)
        return F.struct(
            F.when(same, mid).otherwise(span["lo"]).alias("lo"),
            F.when(same, span["hi"]).otherwise(mid - 1).alias("hi"),
        )

    steps = F.sequence(F.lit(1), F.lit(31))
    return F.left(a, F.aggregate(steps, start, halve, lambda span: span["lo"]))
