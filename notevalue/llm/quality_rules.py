"""Quality rules: simple counts, and divergence from what the language usually looks like.

For each language, however small, the corpus gives a reference: the shares of six character classes, and of its
common words, those that make up at least one in two hundred of its words (so at most two hundred).
A text whose histogram is further from its language's reference than a limit, by Jensen-Shannon
distance, is rejected; texts that are too short to tell are not. All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notevalue.llm.rows import NO_SPACE, SPACE, let
from notevalue.session import cut

WINDOW = 3
LEAST_WORDS = 50
# The share of a language's words that makes a word a common one, and of the corpus's rows or
# characters that makes a language a large one. References of large languages are broadcast; those
# of all others are joined by key, where none has more than this share of the rows or the text.
COMMON_SHARE = 1 / 200
LANGUAGE_SHARE = 1 / 1000
BUCKETS = 65_536
# Guards and limits: a shorter text's histogram says too little; limits are distances from 0 to 1.
GUARD_CHARACTERS = 200
GUARD_WORDS = 60
CHARACTER_LIMIT = 0.21
WORD_LIMIT = 0.4
# Taken off one after the other; what is left is the last class.
CLASSES = (("lower", r"\p{Ll}+"), ("space", r"[\x20\x09-\x0D]+"), ("upper", r"\p{Lu}+"), ("mark", r"[.,;:!?'\"()\-]+"), ("digit", r"\p{Nd}+"))
NAMES = (*(name for name, _ in CLASSES), "other")


def class_counts(docs: DataFrame, text: str) -> DataFrame:
    """`docs` with `shape`, the number of code points in each of NAMES, and `other`, those of the last one."""
    rest = docs.withColumn("rest0", F.coalesce(F.col(text), F.lit("")))
    for i, (_, expression) in enumerate(CLASSES):
        rest = rest.withColumn(f"rest{i + 1}", F.regexp_replace(f"rest{i}", expression, ""))
    sizes = [F.length(f"rest{i}") for i in range(len(NAMES))]
    counts = [a - b for a, b in zip(sizes, sizes[1:], strict=False)] + [sizes[-1]]
    return rest.withColumns({"shape": F.array(*counts), "other": F.col(f"rest{len(CLASSES)}")}).drop(*[f"rest{i}" for i in range(len(NAMES))])


def spoken(text: Column) -> Column:
    """Lower-cased runs of letters, each between two spaces of its own."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", "  ")), F.lit(" "))


def _words(docs: DataFrame) -> DataFrame:
    return docs.select("language", F.explode(F.split(F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " ")), " ")).alias("word")).filter("word <> ''")


def _common(found: DataFrame) -> DataFrame:
    """`language, common` from `language, words, word, n`."""
    often = found.filter(F.col("n") >= F.col("words") * COMMON_SHARE)
    return often.groupBy("language").agg(F.array_sort(F.collect_list(F.struct("word", (F.col("n") / F.col("words")).alias("share")))).alias("common"))


def _common_of_large(docs: DataFrame) -> DataFrame:
    """A word that reaches the share lies in a hash bucket that does, so words are counted only in such buckets."""
    words = _words(docs)
    bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).alias("bucket")
    counted = cut(words.groupBy("language", bucket).agg(F.count("*").alias("n")))
    totals = counted.groupBy("language").agg(F.sum("n").alias("words"))
    heavy = counted.join(F.broadcast(totals), "language").filter(F.col("n") >= F.col("words") * COMMON_SHARE).select("language", "bucket", "words")
    return _common(words.withColumn("bucket", bucket).join(F.broadcast(heavy), ["language", "bucket"]).groupBy("language", "words", "word").agg(F.count("*").alias("n")))


def _common_of_small(docs: DataFrame) -> DataFrame:
    """However many languages there are, nothing is broadcast: counts of their words are dealt by language and word."""
    counted = cut(_words(docs).groupBy("language", "word").agg(F.count("*").alias("n")))
    return _common(counted.join(counted.groupBy("language").agg(F.sum("n").alias("words")), "language"))


def references(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """`language, large, shape_share, common, common_share` of every language, written once; common words are exact."""
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("language"), F.col(text).alias("text"))
    size = sum((F.col(n) for n in NAMES), F.lit(0))
    shapes = class_counts(docs, "text").groupBy("language").agg(F.count("*").alias("rows"), *[F.sum(F.col("shape")[i]).alias(n) for i, n in enumerate(NAMES)])
    shapes = cut(shapes.withColumn("size", size))
    every = shapes.agg(F.sum("rows").alias("rows"), F.sum("size").alias("size")).first()
    large = (F.col("rows") >= (every["rows"] or 0) * LANGUAGE_SHARE) | (F.col("size") >= (every["size"] or 0) * LANGUAGE_SHARE)
    shapes = shapes.select("language", large.alias("large"), F.array(*[F.col(n) / F.greatest("size", F.lit(1)) for n in NAMES]).alias("shape_share"))
    if shapes.filter("NOT large").isEmpty():
        common = _common_of_large(docs)
    else:
        names = F.broadcast(shapes.filter("large").select("language"))
        common = _common_of_large(docs.join(names, "language", "left_semi")).unionByName(_common_of_small(docs.join(names, "language", "left_anti")))
    return cut(shapes.join(common, "language", "left").select(
        "language", "large", "shape_share", F.coalesce("common.word", F.array().cast("array<string>")).alias("common"), F.coalesce("common.share", F.array().cast("array<double>")).alias("common_share")
    ))


def divergence(p: Column, q: Column) -> Column:
    """The Jensen-Shannon distance of two share arrays of one length: 0 for equal, 1 for disjoint ones."""

    def part(a: Column, b: Column) -> Column:
        one = F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
        return one + F.when(b > 0, b * F.log2(2 * b / (a + b))).otherwise(F.lit(0.0))

    total = F.aggregate(F.zip_with(p, q, part), F.lit(0.0), lambda s, x: s + x)
    # greatest and least pass over nulls; a missing histogram has no distance.
    return F.when(total.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total / 2))))


def _repeated_words(words: str) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text."""
    last = F.size(words) - WINDOW + 1
    at = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col(words), i + k - 1) for k in range(WINDOW)]))

    def twice(rows: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return (F.get(rows, k - 1)["h"] == x["h"]) | (F.get(rows, k + 1)["h"] == x["h"])

        return F.transform(F.filter(rows, lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"])

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)

    def counted(hashed: Column) -> Column:
        # sort_array orders natively; array_sort would evaluate its comparison as an expression for every pair.
        rows = F.sort_array(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))
        # Most texts repeat no window, which a hash set tells without sorting.
        return F.when(F.size(F.array_distinct(hashed)) == F.size(hashed), 0).otherwise(let(rows, lambda rows: let(F.sort_array(twice(rows)), covered)))

    return let(hashes, counted)


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """The base counts of `body`, next to what the distances need."""
    rows = rows.withColumn("words", F.array_remove(F.split("body", SPACE), "")).withColumn("lines", F.filter(F.split("body", "\n"), lambda x: F.regexp_like(x, F.lit(NO_SPACE))))
    rows = class_counts(rows, "body")
    return rows.select(
        key, "language", "body", "shape",
        F.size("words").cast("long").alias("n_words"),
        (F.length("body") - F.col("shape")[1]).cast("long").alias("word_chars"),
        # No symbol is in a class of its own, so what the classes leave holds them all.
        (F.length("other") - F.length(F.regexp_replace("other", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words("words").cast("long").alias("n_repeat_words"),
    )


def judge(docs: DataFrame, reference: DataFrame | None = None, key: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """Per row of `docs`: the base counts, both distances, `base_failed` and `kept`.

    `reference` is as `references` returns it. Distances are null where a guard holds or the language
    is not in it, and then reject nothing. A null text is an empty one: all counts 0, rejected by the word count. A null language
    is one of its own. Windows are compared by a 64-bit hash. Repeated rows stay; no rows give none.
    """
    reference = references(docs, lang, text) if reference is None else reference
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("language"), body.alias("body"))
    large, small = F.broadcast(reference.filter("large")), reference.filter("NOT large")
    if small.isEmpty():
        rows = _counted(rows, key).join(large, "language", "left")
    else:
        names = F.broadcast(reference.filter("large").select("language"))
        rest = _counted(rows.join(names, "language", "left_anti"), key).join(small, "language", "left")
        rows = _counted(rows.join(names, "language", "left_semi"), key).join(large, "language").unionByName(rest)
    rows = rows.withColumn("said", spoken(F.col("body")))
    size = F.length("body")
    said = (F.octet_length("said") - F.octet_length(F.replace("said", F.lit("  "), F.lit("")))) / 2 + 1
    times = F.transform("common", lambda w: (F.octet_length("said") - F.octet_length(F.replace(F.col("said"), F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.octet_length(w) + 2))
    rows = rows.withColumn("said_words", F.when(F.length("said") > 2, said).otherwise(F.lit(0.0)))
    rows = rows.withColumn("spoken_share", F.when((F.col("said_words") >= GUARD_WORDS) & (F.size("common") > 0), F.transform(times, lambda t: t / F.col("said_words"))))
    with_rest = lambda shares: let(F.aggregate(shares, F.lit(0.0), lambda s, x: s + x), lambda s: F.concat(shares, F.array(F.greatest(F.lit(0.0), 1 - s))))
    words = divergence(with_rest(F.col("common_share")), with_rest(F.col("spoken_share")))
    shape = F.when((size >= GUARD_CHARACTERS) & F.col("shape_share").isNotNull(), divergence(F.col("shape_share"), F.transform("shape", lambda x: x / size)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = (F.coalesce("character_distance", F.lit(0.0)) <= CHARACTER_LIMIT) & (F.coalesce("word_distance", F.lit(0.0)) <= WORD_LIMIT)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select(key, *counts, shape.alias("character_distance"), words.alias("word_distance")).withColumn("base_failed", failed).withColumn("kept", ~failed & near)
