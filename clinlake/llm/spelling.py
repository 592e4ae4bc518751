"""Spelling variants: words one edit apart, found through a dictionary of trie-node pairs.

The prefixes of all words are the nodes of a forward trie, their suffixes those of
a trie of the reversed words. A node's number follows from its parent's number and
its code point, so every task numbers the nodes alike without holding a trie. A
word enters the dictionary under pairs of integers (prefix node, suffix node):
once for each position with the code point there skipped, once for each place
between code points where one could be inserted. Two words are one replacement
apart exactly if they share a skipped pair, and one insertion apart exactly if a
skipped pair of the longer is an inserted pair of the shorter. A pair fixes all
code points but one, so no more words meet under it than the alphabet has letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import map_rows, map_stream, saved, sql_crc32, sql_lower

#: Fixed values of the words: their letters, who loses a code point, and what counts as a word and as its form.
LETTERS = "[A-Za-zÀ-ÿ]"
ONE_IN = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_TIMES = 10
#: Different words of which a task holds counts before it passes them on.
HELD_WORDS = 100_000
#: Node numbers are polynomials of the path's code points modulo a prime, by one base per trie.
PRIME = (1 << 61) - 1
FORWARD, REVERSED = 1_091_893_451_236_547, 842_507_714_039_711

_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _lower(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_UPPER)


def words_in(doc_id, text: str, least: int = LEAST_LENGTH) -> Counter:
    """Counts of a text's words of at least ``least`` code points, each run spelt as its document spells it."""
    runs: Counter = Counter()
    for run, n in Counter(m.group() for m in re.finditer(f"{LETTERS}{{{least},}}", text)).items():
        runs[_lower(run)] += n
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        word = run[: (at := h % len(run))] + run[at + 1 :] if h % ONE_IN == 0 else run
        if len(word) >= least:
            words[word] += n
    return words


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all texts of (doc_id, text), added up in every task before the shuffle."""

    def stream(parts):
        held: Counter = Counter()
        for part in parts:
            for row in part:
                if row["text"]:
                    held.update(words_in(row["doc_id"], row["text"]))
                if len(held) > HELD_WORDS:
                    yield list(held.items())
                    held = Counter()
        yield list(held.items())

    counted = map_stream(docs.select("doc_id", "text"), "word string, n long", stream)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def node_numbers(word: str, base: int) -> list[int]:
    """Numbers of the trie nodes on a word's path, the root first."""
    nodes = [0]
    for c in word:
        nodes.append((nodes[-1] * base + ord(c) + 1) % PRIME)
    return nodes


def _nodes(words: DataFrame) -> DataFrame:
    """(id, prefix, suffix, skips): the nodes before and after every place of a word, and the positions it may skip.

    Of a run of equal code points only the first is skipped for an insertion, as skipping any gives the same word.
    """

    def start():
        def work(rows):
            out = []
            for r in rows:
                w = r["word"]
                skips = [i == 0 or w[i] != w[i - 1] for i in range(len(w))]
                out.append((r["id"], node_numbers(w, FORWARD), node_numbers(w[::-1], REVERSED)[::-1], skips))
            return out

        return work

    return map_rows(
        words.select("id", "word"), "id long, prefix array<long>, suffix array<long>, skips array<boolean>", start, "word"
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): ids of all pairs of different words (id, word) that are one edit apart, each pair once.

    Candidates meet on integer pairs; the edit is confirmed on the words, as two
    nodes of one trie may share a number (chance about 2**-56).
    """
    nodes = _nodes(words)
    skipped = nodes.select(
        "id", F.explode(F.arrays_zip(
            F.slice("prefix", F.lit(1), F.size("skips")).alias("p"), F.slice("suffix", F.lit(2), F.size("skips")).alias("s"),
            F.col("skips").alias("first"),
        )).alias("at")
    ).select("id", "at.p", "at.s", "at.first")
    inserted = nodes.select("id", F.explode(F.arrays_zip("prefix", "suffix")).alias("at")).select(
        F.col("id").alias("other"), F.col("at.prefix").alias("p"), F.col("at.suffix").alias("s")
    )
    same_place = skipped.select(F.col("id").alias("other"), "p", "s")
    replaced = skipped.join(same_place, ["p", "s"]).where("id < other").select("id", "other")
    longer = skipped.where("first").join(inserted, ["p", "s"]).select(
        F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other")
    )
    a = words.select(F.col("id"), F.col("word").alias("one"))
    b = words.select(F.col("id").alias("other"), F.col("word").alias("two"))
    found = replaced.unionAll(longer).join(a, "id").join(b, "other")
    return found.where(F.levenshtein("one", "two", 1) == 1).select(F.col("id").alias("a"), F.col("other").alias("b"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root_id): the last word of every chain of forms (id, form_id).

    Every step doubles what is followed. Along a chain n grows tenfold from word
    to word, so a chain of 2**k words needs k steps and k stays below 5.
    """
    spark = forms.sparkSession
    ways = saved(spark, forms.select("id", F.col("form_id").alias("to"), F.lit(True).alias("open")), "chains")
    while not ways.where("open").isEmpty():
        ahead = ways.select(F.col("id").alias("at"), F.col("to").alias("beyond"))
        ways = saved(spark, ways.join(ahead, F.col("to") == F.col("at"), "left").select(
            "id", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("open")
        ), "chains")
    return ways.select("id", F.col("to").alias("root_id"))


def group_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word of a table (doc_id, text) with its commoner spelling.

    Words are the maximal runs of letters of whole texts, A-Z lower-cased, at least
    7 code points long and met at least twice; a run whose crc32 with its document's
    id is divisible by 31 loses one code point first. ``form`` is the near word (one
    code point inserted, deleted or replaced) of largest n, ties to the smallest in
    code-point order, if its n is at least ten times the word's; ``root`` follows the
    forms to the last. NULL and empty texts have no words, a NULL id counts as an
    empty one, repeated rows count as often as they are there. Words of any length
    are handled: a word enters the dictionary by numbers, not by copies of itself.
    Other columns are ignored; an empty table gives no words.
    """
    spark = docs.sparkSession
    counted = count_words(docs).where(F.col("n") >= LEAST_COUNT)
    words = saved(spark, counted.withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = saved(spark, near_pairs(words), "pairs")
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("near_id")).unionAll(
        pairs.select(F.col("b").alias("id"), F.col("a").alias("near_id"))
    )
    other = words.select(F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = both.join(other, "near_id").groupBy("id").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near", "near_id")).alias("best")
    )
    is_form = -F.col("best.less") >= FORM_TIMES * F.col("n")
    known = saved(spark, words.join(best, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, F.col("best.near_id")).alias("form_id"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    ), "forms")
    roots = _roots(known.where("form_id is not null").select("id", "form_id"))
    last = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    ends = roots.join(last, "root_id").select("id", "root")
    return known.join(ends, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: The same result in DuckDB, over the same table; pairs of strings in place of pairs of nodes.
ORACLE = f"""
WITH RECURSIVE runs AS (
  SELECT run, {sql_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({sql_lower("text")}, '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY doc_id, run
), counted AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {ONE_IN} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM runs) GROUP BY word HAVING length(word) >= {LEAST_LENGTH} AND sum(n) >= {LEAST_COUNT}
), skipped AS (
  SELECT word, left(word, i) AS head, substr(word, i + 2) AS tail
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM counted)
), shorter AS (
  SELECT s.word, c.word AS other FROM skipped s JOIN counted c ON c.word = s.head || s.tail
), near AS (
  SELECT a.word, b.word AS other FROM skipped a JOIN skipped b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT word, other FROM shorter UNION SELECT other, word FROM shorter
), best AS (
  SELECT near.word, count(*) AS n_near, first(o.word ORDER BY o.n DESC, encode(o.word)) AS other, max(o.n) AS other_n
  FROM near JOIN counted o ON o.word = near.other GROUP BY near.word
), forms AS (
  SELECT c.word, c.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= {FORM_TIMES} * c.n THEN b.other END AS form,
    CASE WHEN b.other_n >= {FORM_TIMES} * c.n THEN b.other_n END AS form_n
  FROM counted c LEFT JOIN best b ON b.word = c.word
), ends(word, root) AS (
  SELECT word, word FROM forms WHERE form IS NULL
  UNION ALL SELECT f.word, e.root FROM ends e JOIN forms f ON f.form = e.word
)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON e.word = f.word
"""
