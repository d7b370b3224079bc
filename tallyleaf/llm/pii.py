"""Personal data: spans of known kinds, and terms that disclose them by what the corpus says, by SQL expressions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyleaf.llm.tables import new_table
from tallyleaf.operators.skew import salted_join
from tallyleaf.session import cut_lineage

#: Fixed values. Possessive repetition changes no match here; it keeps long runs from being tried again and again.
#: The first group lets a match begin only where a run begins or the last match ended: elsewhere it would fail the same way.
KINDS = (
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
#: What a text must hold for a kind to be searched in it.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: Stands for each character of a base span when words are cut, so that what touches a span is no word of the text.
MASK = "\uffff"
WORD = rf"[\p{{L}}{MASK}][\p{{L}}\p{{M}}\p{{N}}{MASK}]{{2,}}"
#: A protected value is judged from this many different texts on: what few texts hold together may be chance.
SUPPORT = 4
#: A term discloses a value if it gives away at least this share of the value's information content.
DISCLOSURE = 0.8
SPANS = "array<struct<start:int,end:int,value:string>>"
PLACES = "array<struct<start:int,end:int>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def add(total, i):
        d = F.substring(digits, i, 1).cast("int")
        doubled = F.when(i % 2 == 0, 2 * d - F.when(d > 4, F.lit(9)).otherwise(F.lit(0))).otherwise(d)
        return total + doubled

    # Longer strings are not cards; they get an empty sequence instead of a sum.
    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind, value: Column) -> Column:
    if kind == "ip":
        return F.rlike(value, F.lit(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
    if kind == "card":
        length = F.length(_digits(value))
        return F.when(length.between(16, 19), _luhn(value)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def find_all(text: Column, pattern: str, wanted=None) -> Column:
    """All matches, leftmost first, without overlap, as (start, end, value) in code points, end exclusive.

    With ``wanted``, a condition on the value, only the matches that meet it.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda b: F.length(b))
    pairs = F.slice(F.arrays_zip(gaps.alias("gap"), found.alias("value")), F.lit(1), F.size(found))
    none = F.array().cast(SPANS)

    def step(state, pair):
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        out = F.concat(state["out"], F.array(span))
        if wanted is not None:
            out = F.when(wanted(pair["value"]), out).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    folded = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step)
    return F.when(F.size(found) > 0, folded["out"]).otherwise(none)


MARKS = "array<struct<kind:string,start:int,end:int,value:string>>"


def base_marks(text: Column) -> Column:
    """The spans of all kinds, by kind and then by start."""

    def of_kind(kind, pattern):
        spans = F.filter(find_all(text, pattern), lambda s: _valid(kind, s["value"]))
        marks = F.transform(
            spans,
            lambda s: F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")
            ),
        )
        return F.when(F.rlike(text, F.lit(HINTS[kind])), marks).otherwise(F.array().cast(MARKS))

    return F.concat(*[of_kind(kind, pattern) for kind, pattern in KINDS])


def masked(text: Column, marks: Column) -> Column:
    """The text, as long as it is, with MASK for every character of a base span."""
    places = F.array_sort(F.transform(marks, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))))

    def step(state, m):
        first = F.greatest(m["start"], state["at"])
        kept = F.substring(text, state["at"] + 1, first - state["at"])
        parts = F.concat(state["out"], F.array(kept, F.repeat(F.lit(MASK), m["end"] - first)))
        added = F.struct(m["end"].alias("at"), parts.alias("out"))
        return F.when(m["end"] > state["at"], added).otherwise(state)

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    folded = F.aggregate(places, start, step)
    whole = F.concat(F.array_join(folded["out"], ""), F.substring(text, folded["at"] + 1, F.length(text)))
    return F.when(F.size(marks) > 0, whole).otherwise(text)


def _term(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def with_words(texts: DataFrame) -> DataFrame:
    """(content, words) per row of ``texts(content, text)``: the distinct whole words outside base spans, as hashes."""
    marked = texts.select("content", "text", base_marks(F.col("text")).alias("marks"))
    plain = marked.select("content", masked(F.col("text"), F.col("marks")).alias("plain"))
    said = F.regexp_extract_all("plain", F.lit(WORD), F.lit(0))
    words = F.filter(said, lambda w: ~F.contains(w, F.lit(MASK)))
    return plain.select("content", F.array_distinct(F.transform(words, _term)).alias("words"))


def term_counts(texts: DataFrame) -> DataFrame:
    """In how many documents each term occurs: (term, of_term), the term as a hash. Counted before anything is shuffled."""
    each = with_words(texts).select(F.explode("words").alias("term"))
    return each.groupBy("term").agg(F.count("*").alias("of_term"))


def protected(rows: DataFrame) -> DataFrame:
    """(content, copies, values) of each different text with values met in at least SUPPORT different texts.

    ``values`` are (entity, of_value); ``of_value`` counts documents, as ``copies`` does. No other value can disclose.
    """
    entities = F.array_distinct(F.transform("marks", lambda m: F.xxhash64(m["kind"], m["value"])))
    held = rows.where(F.size("marks") > 0).select("content", entities.alias("entities"))
    held = held.groupBy("content").agg(F.count("*").alias("copies"), F.first("entities").alias("entities"))
    held = cut_lineage(held.select("content", "copies", F.explode("entities").alias("entity")))
    met = held.groupBy("entity").agg(F.sum("copies").alias("of_value"), F.count("*").alias("texts"))
    met = new_table(met.where(F.col("texts") >= SUPPORT).drop("texts"), "protected-values")
    found = salted_join(held, met, ["entity"], ["content"])
    values = F.collect_list(F.struct("entity", "of_value")).alias("values")
    return new_table(found.groupBy("content").agg(F.first("copies").alias("copies"), values), "protected-texts")


def disclosing(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(entity, term) where a term that occurs in one text with a protected value discloses it.

    A term gives away PMI(t; v) = log(N n(t,v) / (n(t) n(v))) of the information content IC(v) = log(N / n(v)) of a value.
    All counts are of documents with whole texts. Both must have been met together in at least SUPPORT different texts.
    As n(t,v) <= n(v), a term with n(t) > n(v)^DISCLOSURE N^(1 - DISCLOSURE) cannot disclose the value: such pairs,
    among them all with common words, are left out before pairs are made, which changes no result.
    """
    n_texts = float(max(rows.count(), 1))
    held = protected(rows)

    def most_of_term(of_value):
        # The little more is for rounding.
        return F.pow(of_value, F.lit(DISCLOSURE)) * F.pow(F.lit(n_texts), F.lit(1 - DISCLOSURE)) * (1 + 1e-9)

    terms = term_counts(texts).where(F.col("of_term") >= SUPPORT)
    # One of the copies, before the join: a text copied very often is then no hot key.
    hinted = texts.where(F.rlike("text", F.lit("|".join(HINTS.values()))))
    own = hinted.dropDuplicates(["content"]).join(held.select("content"), "content", "left_semi")
    said = with_words(own).join(held, "content")
    largest = F.array_max(F.transform("values", lambda v: v["of_value"]))
    said = said.select("content", "copies", "values", largest.alias("largest"), F.explode("words").alias("term"))
    rare = salted_join(said, terms, ["term"], ["content"]).where(F.col("of_term") <= most_of_term(F.col("largest")))
    pairs = rare.select("term", "of_term", "copies", F.explode("values").alias("v"))
    pairs = pairs.where(F.col("of_term") <= most_of_term(F.col("v.of_value")))
    met = pairs.groupBy(F.col("v.entity").alias("entity"), "term", F.col("v.of_value").alias("of_value"), "of_term").agg(
        F.sum("copies").alias("both"), F.count("*").alias("texts")
    )
    content = F.ln(F.lit(n_texts) / F.col("of_value"))
    given = F.ln(F.lit(n_texts) * F.col("both") / (F.col("of_term") * F.col("of_value")))
    told = met.where((F.col("texts") >= SUPPORT) & (content > 0) & (given >= DISCLOSURE * content))
    return told.select("entity", "term")


def places_of(told: DataFrame, texts: DataFrame) -> DataFrame:
    """(content, terms) of each different text in which terms of ``told(term)`` occur: all their places (start, end)."""
    each = with_words(texts).select("content", F.explode("words").alias("term"))
    met = salted_join(each, told, ["term"], ["content"])
    met = new_table(met.groupBy("content").agg(F.collect_set("term").alias("told")), "disclosing-texts")
    own = texts.join(met.select("content"), "content", "left_semi").dropDuplicates(["content"]).join(met, "content")
    marked = own.select("content", "text", "told", base_marks(F.col("text")).alias("marks"))
    plain = marked.select("content", "told", masked(F.col("text"), F.col("marks")).alias("plain"))
    found = find_all(F.col("plain"), WORD, lambda w: ~F.contains(w, F.lit(MASK)) & F.array_contains("told", _term(w)))
    return plain.select(
        "content", F.transform(found, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("terms")
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """(doc_id, marks, terms) per row of ``docs(doc_id, text)``: what to take out of each text.

    ``marks`` are the base spans, ``terms`` the places (start, end) of terms that disclose a value, without those inside
    or touching a base span. Terms are counted over whole texts, and a term that discloses any value is taken out
    everywhere it occurs: in documents without the value too, since there it leads a reader to the value as well.
    Null texts count as empty, repeated rows each get their row, other columns are ignored. Copies do not make a term
    look telling: it takes SUPPORT different texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("content"), "text")
    rows = cut_lineage(texts.select("doc_id", "content", base_marks(F.col("text")).alias("marks")))
    texts = texts.select("content", "text")
    told = new_table(disclosing(rows, texts).select("term").distinct(), "disclosing-terms")
    joined = salted_join(rows, cut_lineage(places_of(told, texts)), ["content"], ["doc_id"], "left")
    return joined.select("doc_id", "marks", F.coalesce("terms", F.array().cast(PLACES)).alias("terms"))


def report(found: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans and all spans as ``kind:start:end``, by kind and start."""
    joined = [F.transform("marks", lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string")))]
    joined.append(F.transform("terms", lambda t: F.concat_ws(":", F.lit("term"), t["start"].cast("string"), t["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("marks", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind, _ in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.array_join(joined[0], ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*joined), ",").alias("spans"),
    )


def redacted(text: Column, marks: Column, terms: Column) -> Column:
    """The text with base spans generalised to their kind and disclosing terms removed; of overlapping spans the first counts."""
    places = F.concat(
        F.transform(marks, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.concat(F.lit("["), m["kind"], F.lit("]")).alias("by"))),
        F.transform(terms, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit("").alias("by"))),
    )

    def step(state, p):
        kept = F.substring(text, state["at"] + 1, p["start"] - state["at"])
        added = F.struct(p["end"].alias("at"), F.concat(state["out"], F.array(kept, p["by"])).alias("out"))
        return F.when(p["start"] >= state["at"], added).otherwise(state)

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    folded = F.aggregate(F.array_sort(places), start, step)
    return F.concat(F.array_join(folded["out"], ""), F.substring(text, folded["at"] + 1, F.length(text)))
