"""Quality rules by distribution divergence, in DataFrame functions only.

A document's base counts (words, symbols, repeated lines and windows) come
first. Documents that pass them are then compared with language references:
the Jensen-Shannon distance between histograms of character classes and of
common words. The references are the mean histograms of all documents of a
language that pass the base counts, if there are MIN_SUPPORT of them; a document is held against the nearest
one, so a wrong or missing language label does no harm. Its own part is left out of its language's
mean, and a label that few documents bear has no reference: they are held against the
other languages, so junk can't vouch for itself by a label of its own. If no language has
documents enough, all of them together, the document too, make the one reference. In a short text one
odd word (a card number, an address) moves the histogram far, so the allowed
distance grows as the text gets shorter, see ``allowed``.

Defined results: null and empty texts have no words and fail the base rule;
a text without a character of any class, or a table where no document passes
the base counts, has distance 0 (nothing to compare with); a null lang is the empty one; very long texts are counted whole;
repeated rows are judged one by one, and each counts in its language's mean; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import SPACES, join_hot, stored

MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Documents that a language's reference needs, and the share of all (one part of so many) from which it is a common one.
MIN_SUPPORT = 20
COMMON_PARTS = 1000
SYMBOLS = "#*$%&|<>"
#: One odd word that a text may hold beside its prose: a card number of 19 digits with four signs between them.
ODD_CHARS = 23
ODD_WORDS = 1
#: Largest distances (0 to 1) at which a document is kept, for long texts; see ``allowed``.
MAX_CHAR_DISTANCE = 0.16
MAX_WORD_DISTANCE = 0.29

# Common words of four languages, in no special order of merit.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "with"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por"],
}
WORDS = sorted({w for ws in COMMON_WORDS.values() for w in ws})
#: Spellings that count as one of WORDS: small or capitalised, bare or before a stop or comma.
SPELLINGS = [x + end for w in WORDS for x in sorted({w, w.capitalize()}) for end in ("", ".", ",")]
#: Character classes by the characters they hold. Space and what lies beyond ASCII (in bytes) are
#: counted too; the rest, small letters mostly, is a class of its own.
CLASSES = {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "stop": ".,;:?'\"()-",
    "mark": "!#*$%&|<>@+=/_~^{}[]\\",
}


def words_of(text: Column) -> Column:
    """Words between ASCII white space; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def _count(text: str, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def base_counts(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words and rare (its rarer characters) added."""
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = "^[\\x20\\x09-\\x0D]*$"
    # what is left beside small letters and spaces is short: characters are counted there
    rare = F.regexp_replace(text, "[a-z ]+", "")
    df = docs.withColumns({"words": words_of(F.col("text")), "rare": rare, "_lines": F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(blank))})
    n = F.size("words")
    hashes = F.slice(F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))), 1, F.greatest(n - 2, F.lit(0)))
    df = df.withColumns({"n_words": n.cast("long"), "_hashes": hashes})
    # equal windows are neighbours once sorted; those that occur twice or more, once each
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.sort_array("_hashes")))
    twice = F.array_distinct(F.filter("_sorted", lambda h, j: (j > 0) & (F.get("_sorted", j - 1) == h)))
    df = df.withColumn("_twice", twice)
    # where they stand: looked up in a short list, else by one sort of all windows with their places
    few = F.filter(F.transform("_hashes", lambda h, i: F.when(F.array_contains("_twice", h), i)), lambda i: i.isNotNull())
    placed = F.when(F.size("_twice") > 32, F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_placed", placed)
    many = F.filter("_placed", lambda x, j: F.coalesce(F.get("_placed", j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("_placed", j + 1)["h"] == x["h"], F.lit(False)))
    df = df.withColumn("_at", F.when(F.size("_twice") > 32, F.sort_array(F.transform(many, lambda x: x["i"]))).when(F.size("_twice") > 0, few))
    # each repeated window adds the words that the one before it has not covered
    covered = F.aggregate(
        F.transform("_at", lambda p, k: F.least(F.lit(3), F.when(k > 0, p - F.get("_at", k - 1)).otherwise(3))),
        F.lit(0), lambda acc, x: acc + x)
    return df.withColumns({
        "word_chars": (F.length(F.replace(text, F.lit(" "), F.lit(""))) - _count("rare", SPACES)).cast("long"),
        "n_symbols": _count("rare", SYMBOLS).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    }).drop("_lines", "_hashes", "_sorted", "_twice", "_placed", "_at")


def _histograms(df: DataFrame) -> DataFrame:
    """Counts by character class and by common word, as two arrays; see SPELLINGS."""
    text = F.coalesce(F.col("text"), F.lit(""))
    known = F.transform(F.filter("words", lambda w: w.isin(SPELLINGS)), lambda w: F.rtrim(F.lower(w), F.lit(".,")))
    classes = [_count("rare", v) for v in CLASSES.values()]
    df = df.withColumns({"_known": known, "_classes": F.array(*classes, F.length(text) - F.col("word_chars").cast("int"), F.octet_length(text) - F.length(text))})
    each = F.transform(F.array(*[F.lit(w) for w in WORDS]), lambda w: F.size(F.filter("_known", lambda x: x == w)))
    return df.withColumns({
        "chars": F.concat("_classes", F.array(F.greatest(F.lit(0), F.length(text) - _sum("_classes")))),
        "commons": F.concat(each, F.array(F.size("words") - F.size("_known"))),
    }).drop("_known", "_classes", "words", "rare")


def _sum(array: str) -> Column:
    return F.aggregate(array, F.lit(0), lambda acc, x: acc + x)


def _shares(array: str) -> Column:
    total = F.greatest(_sum(array), F.lit(1))
    return F.transform(array, lambda x: x / total)


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two histograms (arrays) that each add up to 1."""
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)) / 2)


def allowed(distance: float, odd: int, n: Column) -> Column:
    """Largest distance of a text of ``n`` characters (words) of which ``odd`` are foreign and the rest is at ``distance``.

    The squared distance is convex and 1 at most, so a share e of foreign
    characters makes of d*d at most (1 - e) * d*d + e.
    """
    share = F.least(F.lit(1.0), odd / F.greatest(n, F.lit(1)))
    return F.sqrt((1 - share) * F.lit(distance * distance) + share)


def _references(table: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Per lang: its rows, those that pass the base counts (``support``), and their mean histograms; written."""
    passed = ~F.col("base_failed")
    support = F.count_if(passed).alias("support")
    means = [F.array(*[F.avg(F.when(passed, F.get(p, F.lit(i)))) for i in range(n)]).alias(p) for p, n in sizes.items()]
    return stored(table.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), support, *means), "quality_references")


def _pooled(refs: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """One reference of all documents that pass the base counts, for tables without a language that has enough."""
    weighted = [F.array(*[F.sum(F.get(p, F.lit(i)) * F.col("support")) / F.sum("support") for i in range(n)]).alias(p) for p, n in sizes.items()]
    return refs.where("support > 0").agg(F.lit(None).cast("string").alias("lang"), F.sum("support").alias("support"), *weighted).where("support > 0")


def _left_out(ref: Column, own: Column, support: Column, member: Column) -> Column:
    """A mean histogram without the document's own part, if it has one."""
    return F.zip_with(ref, own, lambda m, x: F.when(member, F.greatest(F.lit(0.0), (m * support - x) / F.greatest(support - 1, F.lit(1)))).otherwise(m))


def _own_reference(table: DataFrame, refs: DataFrame, common: list[str]) -> DataFrame:
    """table with ``own``, the reference of the document's language if it has one and is not among the common ones.

    Rows of common languages stay where they are; only the others are dealt by language, no matter
    how many of them one language has.
    """
    kind = refs.select(F.struct("lang", "support", "pc", "pw").alias("own")).schema["own"].dataType
    rest = refs.where(~F.col("lang").isin(common))
    own = rest.select("lang", "rows", F.when(F.col("support") >= MIN_SUPPORT, F.struct("lang", "support", "pc", "pw")).alias("own"))
    if own.where("own is not null").isEmpty():
        return table.withColumn("own", F.lit(None).cast(kind))
    there = table.where(F.col("lang").isin(common)).withColumn("own", F.lit(None).cast(kind))
    elsewhere = join_hot(table.where(~F.col("lang").isin(common)), own, "lang", "rows").drop("rows")
    return there.unionByName(elsewhere)


def quality_rules(docs: DataFrame, max_char_distance: float = MAX_CHAR_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, base counts, base_failed, char_distance, word_distance, kept.

    The histograms are computed once and written; the references come from that narrow table.
    The common ones (each of a thousandth of the documents at least, so a thousand at most) are
    broadcast to all documents; a rarer language's reference is joined to its own documents. The columns
    of docs named in ``carry`` go along, as the struct ``row``.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    row = [F.struct(*carry).alias("row")] if carry else []
    df = docs.select("doc_id", F.col("text").cast("string").alias("text"), lang.alias("lang"), *row)
    df = _histograms(base_counts(df)).drop("text")
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
    table = stored(df, "quality_histograms")
    table = table.withColumns({"pc": _shares("chars"), "pw": _shares("commons")})
    sizes = {"pc": len(CLASSES) + 3, "pw": len(WORDS) + 1}
    refs = _references(table, sizes)
    least = F.greatest(F.lit(MIN_SUPPORT), F.ceil(F.lit((refs.agg(F.sum("support")).first()[0] or 0) / COMMON_PARTS)))
    common = refs.where(F.col("support") >= least)  # COMMON_PARTS rows at most
    names = [r[0] for r in common.select("lang").collect()]
    if not names:
        common = _pooled(refs, sizes)
    df = _own_reference(table, refs, names).crossJoin(F.broadcast(common.agg(F.collect_list(F.struct("lang", "support", *sizes)).alias("refs"))))
    every = F.when(F.col("own").isNull(), F.col("refs")).otherwise(F.concat("refs", F.array("own")))

    def nearest(p: str) -> Column:
        def distance(r: Column) -> Column:
            member = ~F.col("base_failed") & F.coalesce(r["lang"] == F.col("lang"), F.lit(False))
            return _distance(F.col(p), _left_out(r[p], F.col(p), r["support"], member))

        return F.coalesce(F.array_min(F.transform(every, distance)), F.lit(0.0))

    df = df.withColumns({
        "char_distance": F.when(F.col("word_chars") > 0, nearest("pc")).otherwise(0.0),
        "word_distance": F.when(F.col("n_words") > 0, nearest("pw")).otherwise(0.0),
    })
    near = F.col("char_distance") <= allowed(max_char_distance, ODD_CHARS, F.col("word_chars"))
    near &= F.col("word_distance") <= allowed(max_word_distance, ODD_WORDS, F.col("n_words"))
    kept = ~F.col("base_failed") & near
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", kept.alias("kept"), *(["row"] if carry else []))
