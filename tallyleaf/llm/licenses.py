"""License scan: ordered signature rules over normalised words, by SQL expressions only."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyleaf.llm.license_rules import BASE, LAST, rules


def normalised(text: Column) -> Column:
    """Lower case A-Z, words of ASCII letters and digits or other characters above ASCII, one blank before and after each."""
    # lower() also maps two letters above ASCII into it; other letters above ASCII stay above it, whatever case they get.
    kept = F.replace(F.replace(text, F.lit("K"), F.lit("å")), F.lit("İ"), F.lit("å"))
    words = F.regexp_replace(F.lower(kept), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(text: Column, pattern: Column) -> Column:
    """(first, last) word number of each match of a pattern that begins at a word and ends before a blank.

    The pieces between matches and the matches alternate; words are counted by the blanks before them.
    """
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.transform(between, lambda b: _blanks(b)).alias("gap"), F.transform(found, lambda f: _blanks(f)).alias("own"))
    start = F.struct(F.lit(0).alias("seen"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))

    def step(state, pair):
        first = state["seen"] + pair["gap"] - 1
        place = F.struct(first.alias("first"), (first + pair["own"]).alias("last"))
        return F.struct(
            (state["seen"] + pair["gap"] + pair["own"]).alias("seen"), F.concat(state["out"], F.array(place)).alias("out")
        )

    matched = F.slice(pairs, F.lit(1), F.size(found))
    return F.when(F.size(found) > 0, F.aggregate(matched, start, step)["out"]).otherwise(start["out"])


def _rule_table():
    base = [(label, 0, phrase, f"(?<= ){phrase}(?= )", 1.0, True) for label, phrase in BASE]
    made = [(label, p, word, f"(?<= ){text}(?= )", weight, False) for label, p, word, text, weight in rules()]
    return F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.lit(p).alias("priority"),
                F.lit(word).alias("word"),
                F.lit(text).alias("pattern"),
                F.lit(weight).alias("weight"),
                F.lit(base).alias("base"),
            )
            for label, p, word, text, weight, base in base + made
        ]
    )


def detections(text: Column) -> Column:
    """All matches of all rules whose keyword occurs in a normalised text, before suppression."""
    tried = F.filter(_rule_table(), lambda r: F.contains(text, r["word"]))

    def of_rule(rule):
        return F.transform(
            _places(text, rule["pattern"]),
            lambda p: F.struct(
                p["first"].alias("first"),
                p["last"].alias("last"),
                rule["priority"].alias("priority"),
                rule["label"].alias("label"),
                rule["weight"].alias("weight"),
                rule["base"].alias("base"),
            ),
        )

    return F.flatten(F.transform(tried, of_rule))


#: Without one of these no rule can match; looked for before the rules are unfolded.
HINTS = r"licen|spdx|permi|redistribution|compliance|free software|unencumbered|public domain|all rights|endorse|advertising|warranty|creativecommons|cc by nc|(?:released|distributed|available|published|provided|used) under "


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, found) per row of ``docs(doc_id, text)``; ``found`` holds the detections that stand.

    Null texts count as empty, other columns are ignored, repeated rows are scanned each for itself. A detection that lies
    within another of the same or a higher priority is suppressed, base phrases never. For that, detections are
    sorted by start and, from the same start, longest first; then one lies within an earlier one exactly if the
    largest end so far reaches its own.
    """
    text = normalised(F.coalesce(F.col("text").cast("string"), F.lit("")))
    words = docs.select(F.col("doc_id").cast("long"), text.alias("words"))
    hinted = F.rlike("words", F.lit(HINTS))
    none = F.array().cast("array<struct<first:int,last:int,priority:int,label:string,weight:double,base:boolean>>")
    found = words.select(
        # Names a row for the steps below only: rows with the same doc_id stay apart.
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.when(F.col("words") == "  ", F.lit(0)).otherwise(_blanks(F.col("words")) - 1).cast("long").alias("n_words"),
        F.when(hinted, detections(F.col("words"))).otherwise(none).alias("all"),
    )
    rows = found.select("row", "doc_id", "n_words", F.explode_outer("all").alias("d"))
    earlier = Window.partitionBy("row", "doc_id").orderBy("d.first", F.desc("d.last"), "d.priority", "d.label")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    covered = F.lit(False)
    for p in range(LAST + 1):
        reach = F.max(F.when(F.col("d.priority") <= p, F.col("d.last"))).over(earlier)
        covered = covered | ((F.col("d.priority") == p) & (reach >= F.col("d.last")))
    stands = F.col("d").isNotNull() & (F.col("d.base") | ~F.coalesce(covered, F.lit(False)))
    marked = rows.withColumn("stands", stands)
    return marked.groupBy("row", "doc_id", "n_words").agg(
        F.array_sort(F.collect_list(F.when(F.col("stands"), F.col("d")))).alias("found")
    ).drop("row")


def report(found: DataFrame) -> DataFrame:
    """One row per document: counts, base and all labels, and a score (the weight of the surest detection)."""
    base = F.filter("found", lambda d: d["base"])
    return found.withColumn("base", base).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.first").cast("long").alias("first_word"),
        F.array_max("base.first").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct("found.label")), ",").alias("labels"),
        F.coalesce(F.array_max("found.weight"), F.lit(0.0)).alias("score"),
    )
