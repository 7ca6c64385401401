"""Quality rules: cross-document line frequency beside counts of the text itself.

Lines are normalised (lower case, runs of blanks as one, trimmed) and hashed. For each host the distinct
documents with a line are counted; copies of a text are one document. Lines in more than
``MIN_DOCUMENTS`` documents and more than ``SHARE`` of the host's documents are removed, and, however large the host, lines
in more than ``ANY_DOCUMENTS``. A document that loses over half of its words that way is depleted and rejected.

Hot hosts, lines and copies: counts combine on the map side before every shuffle. While there are few frequent
lines, a host's are one row, which is sent to the documents. Beyond ``BROADCAST_LINES`` they stay rows of host and line,
which are joined with the documents' lines by a shuffle, and a document gets back those of its own.

Defined results: a null text is an empty text (no words, failed); a null host is the host ``''``;
repeated rows are judged one by one, alike; an empty table gives no rows. Only the columns named in
``rate`` are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.base import stored, table, text_of, words_of

MIN_DOCUMENTS = 20
SHARE = 0.02
ANY_DOCUMENTS = 1000
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3
#: Frequent lines of all hosts (8 bytes each) beyond which they are joined by a shuffle. A document's lines are looked
#: up in its host's one by one, so the bound is for time as well.
BROADCAST_LINES = 20_000


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, though ``then`` uses it inside lambdas."""
    return F.transform(F.array(value), then)[0]


def normal_lines(text: Column) -> Column:
    """Hashes of the normalised lines of a text, in order; 0 words give a null."""
    plain = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    lines = F.transform(F.split(plain, "\n"), lambda line: F.trim(line))
    return F.transform(lines, lambda line: F.when(line != "", F.xxhash64(line)))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in the text, the first one included."""

    def covered(places: Column) -> Column:
        """Words under windows that start at these places, in order."""
        last = F.size(places) - 1
        return F.aggregate(
            F.sequence(F.lit(0), last),
            F.lit(0),
            lambda n, k: n + F.when(k == last, F.lit(window)).otherwise(
                F.least(F.lit(window), F.get(places, k + 1) - F.get(places, k))
            ),
        )

    def from_sorted(grams: Column) -> Column:
        n = F.size(grams)
        same = lambda a, b: F.get(grams, a)["h"] == F.get(grams, b)["h"]
        twice = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda k: ((k > 0) & same(F.greatest(k - 1, F.lit(0)), k)) | ((k < n - 1) & same(k, F.least(k + 1, n - 1))),
        )
        places = F.array_sort(F.transform(twice, lambda k: F.get(grams, k)["i"]))
        return _let(places, covered)

    def from_grams(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(_let(ordered, from_sorted))

    def from_words(w: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)])
        )
        return F.when(F.size(w) < window, F.lit(0)).otherwise(_let(grams, from_grams))

    return _let(words, from_words)


def frequent_lines(
    docs: DataFrame, *, min_documents: int = MIN_DOCUMENTS, share: float = SHARE, any_documents: int = ANY_DOCUMENTS, host: str = "source"
) -> DataFrame:
    """``(host, line)``: the hashes of the lines above the limits."""
    text = text_of()
    rows = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.xxhash64(text).alias("copy"), text.alias("t"))
    lines = rows.select("host", "copy", F.explode(F.array_distinct(F.array_compact(normal_lines(F.col("t"))))).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.countDistinct("copy").alias("n")).filter(F.col("n") > min_documents)
    sizes = rows.groupBy("host").agg(F.countDistinct("copy").alias("size"))
    return (
        counts.join(sizes, "host")
        .filter((F.col("n") > F.lit(share) * F.col("size")) | (F.col("n") > any_documents))
        .select("host", "line")
    )


def _with_lines(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """Rows (``doc_id, host, t``) with the frequent lines that may be theirs; null where there are none."""
    if frequent.count() <= BROADCAST_LINES:
        lists = frequent.groupBy("host").agg(F.collect_set("line").alias("lines"))
        return rows.join(F.broadcast(lists), "host", "left")
    copy = F.xxhash64("t")
    own = rows.select("host", copy.alias("copy"), F.explode(F.array_distinct(F.array_compact(normal_lines(F.col("t"))))).alias("line")).distinct()
    met = own.join(frequent, ["host", "line"]).groupBy("host", "copy").agg(F.collect_set("line").alias("lines"))
    return rows.withColumn("copy", copy).join(met, ["host", "copy"], "left").drop("copy")


def rate(
    docs: DataFrame, *, min_documents: int = MIN_DOCUMENTS, share: float = SHARE, any_documents: int = ANY_DOCUMENTS, host: str = "source"
) -> DataFrame:
    """Per document: counts, the text without frequent lines, and whether it is kept."""
    frequent = frequent_lines(docs, min_documents=min_documents, share=share, any_documents=any_documents, host=host)
    frequent = stored(frequent, "frequent-lines")
    text = text_of()
    rows = docs.select("doc_id", text.alias("t"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"))
    marked = _with_lines(rows, frequent).select(
        "doc_id",
        "t",
        words_of(F.col("t")).alias("w"),
        F.when(
            F.col("lines").isNotNull(),
            F.transform(normal_lines(F.col("t")), lambda h: F.coalesce(F.array_contains("lines", h), F.lit(False))),
        ).alias("marks"),
    )
    any_removed = F.col("marks").isNotNull() & F.exists("marks", lambda m: m)
    pairs = F.zip_with(F.split("t", "\n"), "marks", lambda line, mark: F.struct(line.alias("line"), mark.alias("mark")))
    removed = F.aggregate(
        F.filter(pairs, lambda p: p["mark"]), F.lit(0), lambda n, p: n + F.size(words_of(p["line"]))
    )
    left = F.array_join(F.transform(F.filter(pairs, lambda p: ~p["mark"]), lambda p: p["line"]), "\n")
    counted = marked.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda n, w: n + F.char_length(w)).alias("word_chars"),
        (F.char_length("t") - F.char_length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("t")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).cast("long").alias("n_repeat_words"),
        F.when(any_removed, removed).otherwise(0).cast("long").alias("n_removed_words"),
        F.when(any_removed, left).otherwise(F.col("t")).alias("clean_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    depleted = 2 * F.col("n_removed_words") > F.col("n_words")
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words"
    )


OP4_SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as host, coalesce(text, '') as t from documents
), w as (
  select doc_id, unnest(x) as word, generate_subscripts(x, 1) as p
  from (select doc_id, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda z: z <> '') as x from d)
), g as (
  select doc_id, p, word || ' ' || lead(word) over s || ' ' || lead(word, 2) over s as gram
  from w window s as (partition by doc_id order by p)
), twice as (
  select doc_id, p from g where gram is not null
  qualify count(*) over (partition by doc_id, gram) > 1
), covered as (
  select doc_id, count(distinct p + k) as n_repeat_words from twice, range(3) as r(k) group by doc_id
), counts as (
  select doc_id, count(*) as n_words, sum(length(word)) as word_chars from w group by doc_id
), raw as (
  select doc_id, host, t, unnest(string_split(t, chr(10))) as line from d
), dups as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines from raw
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
), lines as (
  select doc_id, host, t, line, trim(regexp_replace(lower(line), '[\x20\x09\x0B-\x0D]+', ' ', 'g')) as norm from raw
), sizes as (
  select host, count(distinct t) as size from d group by host
), often as (
  select host, norm from (
    select host, norm, count(distinct t) as n from lines where norm <> '' group by host, norm)
  join sizes using (host) where n > 20 and (n > 0.02::double * size or n > 1000)
), lost as (
  select doc_id, sum(len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda z: z <> ''))) as n_removed_words
  from lines semi join often using (host, norm) group by doc_id
), every as (
  select doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
         coalesce(n_removed_words, 0) as n_removed_words
  from d left join counts using (doc_id) left join dups using (doc_id)
  left join covered using (doc_id) left join lost using (doc_id)
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
       (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not 2 * n_removed_words > n_words as kept,
       n_removed_words::bigint as n_removed_words
from every
"""
