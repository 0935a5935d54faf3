"""Quality rules by divergence from a language's usual text.

Two histograms of a document are compared with those of all documents of its
language by the Jensen-Shannon distance (base 2, 0 to 1): the classes of its
characters, and its most common words with one bin for all other words.  Short
texts are noisy, so each comparison has a least length.  Built from DataFrame
functions only; a text is read once, what follows works on its counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.shared import SPACES, cut

# Common words by language.
COMMON = {
    "en": "the of and to a in is that it for on was with as be by this are at from an or not have",
    "de": "der die und in den von zu das mit sich für des auf ist im nicht dem eine ein als auch an es werden",
    "fr": "de la le et les des en un du une est que pour dans qui au par sur pas avec ce il plus ne",
    "es": "de la que el en y los se del las por un con para una no su es al lo como más o pero",
}
#: Characters of each class (letters: less the capitals); all others are "other".
CLASSES = {"upper": r"\p{Lu}", "letter": r"\p{L}", "digit": r"\p{Nd}", "space": r"\x20\x09-\x0D",
           "symbol": "#*$%&|<>"}
#: A text is kept up to a distance of ``limit + noise / sqrt(length)``, in
#: characters or words, as short samples differ more; from a least length.
CHARS_LIMIT, CHARS_NOISE, LEAST_CHARS = 0.14, 2.4, 200
WORDS_LIMIT, WORDS_NOISE, LEAST_WORDS = 0.12, 1.7, 60


def _let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), f)[0]


def _n_of(text: Column, inside: str) -> Column:
    return F.length(F.regexp_replace(text, rf"[^{inside}]+", "")).cast("long")


def _repeats(words: Column) -> Column:
    """Words that lie in 3-word windows found twice or more."""
    n = F.size(words) - 2
    windows = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(s: Column) -> Column:
        again = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        at = F.sort_array(F.transform(again, lambda x: x["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(at, start, lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"]).cast("long")).alias("n")), lambda a: a["n"])
    some = _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
        _let(F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)))
    return F.when(n >= 2, some).otherwise(F.lit(0).cast("long"))


def _common(words: Column, lang: Column) -> Column:
    """Counts (word, n) of the language's common words, the others under ''."""
    def counts(c: Column) -> Column:
        kinds = F.array_distinct(c)
        starts = F.transform(kinds, lambda w: F.array_position(c, w))
        each = F.transform(kinds, lambda w, k: F.struct(w.alias("word"), (F.coalesce(
            F.get(starts, k + 1), F.size(c).cast("long") + 1) - F.get(starts, k)).alias("n")))
        return F.concat(each, F.array(F.struct(F.lit("").alias("word"), (F.size(words) - F.size(c)).cast("long").alias("n"))))
    def among(known: list[str]):
        return lambda w: F.lower(w).isin(known)
    found = F.array().cast("array<string>")
    for code, known in COMMON.items():
        found = F.when(lang == code, F.filter(words, among(known.split()))).otherwise(found)
    return _let(F.sort_array(F.transform(found, lambda w: F.lower(w))), counts)


def measure(docs: DataFrame) -> DataFrame:
    """Counts of every whole text: ``doc_id``, ``lang`` (null: 'und'), the rules'
    columns, ``chars`` (class, n) and ``common`` (word, n).  A null text counts as
    empty.  Other columns of ``docs`` are not read."""
    text, lang = F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("und"))
    split = docs.select("doc_id", lang.alias("lang"), text.alias("text"),
                        F.array_remove(F.split(text, SPACES), "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    classes = {k: _n_of(F.col("text"), c) for k, c in CLASSES.items()}
    classes["letter"] -= classes["upper"]
    length = F.length("text").cast("long")
    return split.select(
        "doc_id", "lang", F.size("words").cast("long").alias("n_words"), length.alias("n_chars"),
        F.struct(*[c.alias(k) for k, c in classes.items()]).alias("class"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _let(F.col("words"), _repeats).alias("n_repeat_words"),
        _let(F.col("words"), lambda w: _common(w, F.col("lang"))).alias("common"))


def _distance(counts: Column, name: str, total: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of counts (name, n) from a map of shares, which
    sum to one; names that the document lacks add half their share."""
    def gain(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    def term(x: Column) -> Column:
        p, q = x["n"] / total, F.coalesce(F.try_element_at(reference, x[name]), F.lit(0.0))
        return 0.5 * (gain(p, q) + gain(q, p) - q)
    sum_ = F.aggregate(counts, F.lit(0.5), lambda a, x: a + term(x))
    return F.round(F.sqrt(F.greatest(sum_, F.lit(0.0))), 6)


def judge(docs: DataFrame, chars: tuple[float, float, int] = (CHARS_LIMIT, CHARS_NOISE, LEAST_CHARS),
          words: tuple[float, float, int] = (WORDS_LIMIT, WORDS_NOISE, LEAST_WORDS)) -> DataFrame:
    """The rules' columns of every row, ``chars_js`` and ``words_js`` (null below
    the least length, or where the language has no common words), and ``kept``.

    References are over all rows of a language; null languages form one of
    their own.  A reference is one row a language and holds the shares of a
    fixed list of classes and words; the counts of a group of rows are summed
    before they are shuffled, so that a frequent language does no harm."""
    rows = cut(measure(docs), "measures")
    order = [*CLASSES, "other"]
    other = F.col("n_chars") - sum((F.col(f"class.{k}") for k in CLASSES), F.lit(0))
    rows = rows.withColumn("chars", F.array(*[F.struct(F.lit(k).alias("name"), (other if k == "other" else F.col(
        f"class.{k}")).alias("n")) for k in order]))

    def shares(column: str, name: str, out: str) -> DataFrame:
        sums = (rows.select("lang", F.explode(column).alias("x")).groupBy("lang", F.col(f"x.{name}").alias("name"))
                .agg(F.sum("x.n").alias("n")))
        whole = sums.groupBy("lang").agg(F.collect_list(F.struct("name", "n")).alias("all"), F.sum("n").alias("total"))
        return whole.select("lang", F.map_from_entries(F.transform("all", lambda x: F.struct(
            x["name"], F.when(F.col("total") > 0, x["n"] / F.col("total")).otherwise(0.0)))).alias(out))
    reference = cut(shares("chars", "name", "char_shares").join(shares("common", "word", "word_shares"), "lang"),
                    "reference")
    scored = rows.join(reference, "lang").withColumns({
        "chars_js": F.when(F.col("n_chars") >= chars[2],
                           _distance(F.col("chars"), "name", F.col("n_chars"), F.col("char_shares"))),
        "words_js": F.when((F.col("n_words") >= words[2]) & F.col("lang").isin(*COMMON),
                           _distance(F.col("common"), "word", F.col("n_words"), F.col("word_shares"))),
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))})
    usual = (F.coalesce(F.col("chars_js") <= chars[0] + chars[1] / F.sqrt("n_chars"), F.lit(True))
             & F.coalesce(F.col("words_js") <= words[0] + words[1] / F.sqrt("n_words"), F.lit(True)))
    return scored.select("doc_id", "n_words", (F.col("n_chars") - F.col("class.space")).alias("word_chars"),
                         F.col("class.symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & usual).alias("kept"), "chars_js", "words_js")


#: DuckDB: the same by joining each document's shares with its language's.
JUDGE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
listed(lang, word) AS (VALUES {listed}),
starts AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d),
around AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three FROM starts),
again AS (SELECT r, i FROM around QUALIFY count(*) OVER (PARTITION BY r, three) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(0, 3) x(k) GROUP BY r),
n AS (
  SELECT r, doc_id, lang, len(w) AS n_words, length(t) AS n_chars,
         length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS upper, length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS letters,
         length(regexp_replace(t, '[^\p{{Nd}}]+', '', 'g')) AS digit, length(regexp_replace(t, '[^\x20\x09-\x0D]+', '', 'g')) AS space,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS symbol, coalesce(covered.n, 0) AS n_repeat_words,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d LEFT JOIN covered USING (r)),
counts AS (
  SELECT r, lang, 'chars' AS kind, unnest(['upper', 'letter', 'digit', 'space', 'symbol', 'other']) AS name,
         unnest([upper, letters - upper, digit, space, symbol, n_chars - letters - digit - space - symbol]) AS c FROM n
  UNION ALL
  SELECT o.r, o.lang, 'words', coalesce(l.word, ''), count(*) FROM (SELECT r, lang, lower(unnest(w)) AS one FROM d) o
  LEFT JOIN listed l ON l.lang = o.lang AND l.word = o.one GROUP BY ALL),
usual AS (SELECT lang, kind, name, sum(c) / sum(sum(c)) OVER (PARTITION BY lang, kind) AS q FROM counts GROUP BY lang, kind, name),
own AS (SELECT r, lang, kind, name, c / sum(c) OVER (PARTITION BY r, kind) AS p FROM counts),
js AS (
  SELECT r, kind, round(sqrt(greatest(sum(
           CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)), 6) AS js
  FROM (SELECT n.r, kind, q, coalesce(p, 0) AS p FROM n JOIN usual USING (lang) LEFT JOIN own USING (r, kind, name)) GROUP BY r, kind),
f AS (
  SELECT n.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_chars >= {least_chars} THEN a.js END AS chars_js,
         CASE WHEN n_words >= {least_words} AND n.lang IN (SELECT lang FROM listed) THEN b.js END AS words_js
  FROM n LEFT JOIN js a ON a.r = n.r AND a.kind = 'chars' LEFT JOIN js b ON b.r = n.r AND b.kind = 'words')
SELECT doc_id, n_words, n_chars - space AS word_chars, symbol AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
       n_repeat_words, base_failed, chars_js, words_js,
       NOT base_failed AND coalesce(chars_js <= {chars_limit} + {chars_noise} / sqrt(n_chars), true)
       AND coalesce(words_js <= {words_limit} + {words_noise} / sqrt(n_words), true) AS kept
FROM f
""".format(listed=", ".join(f"('{lang}', '{w}')" for lang, words in COMMON.items() for w in words.split()),
           least_chars=LEAST_CHARS, least_words=LEAST_WORDS, chars_limit=CHARS_LIMIT, chars_noise=CHARS_NOISE,
           words_limit=WORDS_LIMIT, words_noise=WORDS_NOISE)
