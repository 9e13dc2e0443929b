"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

Words are the runs of Latin letters of all texts (see ``word_counts``). Each has a
vector of letter counts. One replaced letter moves that vector by a squared distance
of 2 within a length, one inserted or deleted letter by 1 between adjacent lengths,
so near words lie at a squared distance of at most two.

* Blocks: words of one length whose letters fall alike into ``LETTER_GROUPS`` (and the
  rest). One edit takes a word into a fixed list of neighbouring blocks, ``steps()``.
  A block of over ``tile`` words is cut into tiles by hash, so no row holds more
  than a tile and the tiles of one number of its neighbours.
* Gram matrices: |a - b|^2 = |a|^2 + |b|^2 - 2ab for all words of a tile against all of
  its neighbours in one NumPy product; pairs at the wanted distance stay.
* Verification: same length and exactly one differing place, or common prefix and
  suffix that cover the shorter word.

Every near pair is met once, at the block whose step leads to the other. Counts and
best partners are reduced in the task, then by word; forms are followed to their roots
by pointer jumping (a form has at least ``dominance`` times the count, so chains are
short and have no cycle).

Nulls: a null text has no words; a null id stands as the empty text in the seed of the
thinning. Empty texts have none. A very long run is a word of its own length block;
counts are summed in doubles where singles would not be exact. Repeated rows count each
time. Ties go to the smallest word in code-point order. Other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LEAST_LENGTH, LEAST_COUNT, DOMINANCE = 7, 2, 10
TILE = 4_096
#: Letters whose counts name a block; all others are the rest.
LETTER_GROUPS = ("ae", "io", "nr", "st", "lcd")
#: Words held by a counting task before it passes its counts on.
HELD_WORDS = 400_000
CELLS = 1 << 22
THIN = 31
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
NEAR = "word string, n_near bigint, best_n bigint, best string"


# -- words ------------------------------------------------------------------
def text_words(doc_id: str, text: str, run: re.Pattern, least: int) -> Iterator[tuple[str, int]]:
    """(word, times) of one text: its runs in lower case, thinned by one code point where 31 divides their hash."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    for word, times in Counter(run.findall(text.encode().translate(LOWER).decode())).items():
        h = zlib.crc32(word.encode(), seed)
        if h % THIN == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1:]
            if len(word) < least:
                continue
        yield word, times


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): distinct words of all texts, counted in the task before the exchange."""
    src = docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a shorter run cannot give a word, and a longer one never matches in parts
        runs = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")
        held: Counter = Counter()
        for pdf in frames:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                for word, times in text_words(doc_id, text, runs, least_length):
                    held[word] += times
                if len(held) > HELD_WORDS:
                    yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})

    return (src.mapInPandas(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# -- blocks -----------------------------------------------------------------
def block_code(word: str) -> F.Column:
    """[length, letters of each group]."""
    size = F.char_length(word)
    return F.array(size, *[size - F.char_length(F.translate(word, g, "")) for g in LETTER_GROUPS])


def steps() -> list[list[int]]:
    """What one edit adds to a block code; of two opposite steps one is listed. The first is no step."""
    unit = [[int(i == k) for i in range(len(LETTER_GROUPS))] for k in range(len(LETTER_GROUPS))] + [[0] * len(LETTER_GROUPS)]
    swaps = [[0, *[b - a for a, b in zip(unit[i], unit[j])]] for i in range(len(unit)) for j in range(i + 1, len(unit))]
    return [[0] * (1 + len(LETTER_GROUPS)), *swaps, *[[1, *u] for u in unit]]


def letter_blocks(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(code, tiles, tile, words, ns): the words of a tile, joined by line ends, and their counts."""
    coded = words.withColumn("code", block_code("word"))
    sizes = coded.groupBy("code").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    rows = coded.join(sizes, "code").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    return (rows.groupBy("code", "tiles", "tile").agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("all"))
            .select("code", "tiles", "tile", F.array_join("all.word", "\n").alias("words"), F.col("all.n").alias("ns")))


def matrix(words: str, length: int) -> np.ndarray:
    """Code points (all below 256) of words of one length, a row each."""
    raw = np.frombuffer((words + "\n").encode("latin-1"), np.uint8)
    return raw.reshape(-1, length + 1)[:, :length]


def letter_counts(chars: np.ndarray, column: np.ndarray, width: int) -> np.ndarray:
    flat = (np.arange(len(chars))[:, None] * width + column[chars]).ravel()
    return np.bincount(flat, minlength=len(chars) * width).reshape(len(chars), width)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of ``a`` and ``b`` (as long, or one longer) that are one replaced or inserted code point apart."""
    n, size = a.shape
    if b.shape[1] == size:
        return (a != b).sum(axis=1) == 1
    stop = np.zeros((n, 1), bool)
    before = np.argmin(np.concatenate([a == b[:, :-1], stop], axis=1), axis=1)
    after = np.argmin(np.concatenate([(a == b[:, 1:])[:, ::-1], stop], axis=1), axis=1)
    return before + after >= size


def near_pairs(home: np.ndarray, other: np.ndarray, upper: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): rows of ``home`` and ``other`` one edit apart; with ``upper`` both are one tile and i < j."""
    size, gap = home.shape[1], other.shape[1] - home.shape[1]
    letters = np.zeros(256, bool)
    letters[home], letters[other] = True, True
    column, width = np.cumsum(letters) - 1, int(letters.sum())
    kind = np.float32 if size < 2_000 else np.float64  # sums of squares stay exact
    a, b = (letter_counts(x, column, width).astype(kind) for x in (home, other))
    own, theirs = (np.einsum("ij,ij->i", x, x) for x in (a, b))
    want = 1 if gap else 2
    found, step = [], max(1, CELLS // max(1, len(other)))
    for k in range(0, len(home), step):
        # the squared distance is ``want`` where the product is half of |a|^2 + |b|^2 - want
        gram = a[k:k + step] @ b.T
        i, j = np.nonzero(2 * gram == own[k:k + step, None] + (theirs - want)[None, :])
        i = i + k
        if upper:
            i, j = i[i < j], j[i < j]
        for c in range(0, len(i), at := max(1, (CELLS * 8) // size)):
            ok = one_edit(home[i[c:c + at]], other[j[c:c + at]])
            found.append((i[c:c + at][ok], j[c:c + at][ok]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def best_partners(words: np.ndarray, owner: np.ndarray, partner: np.ndarray, ns: np.ndarray) -> pd.DataFrame:
    """For each owner its number of partners and the one of largest count, ties to the smallest word."""
    order = np.lexsort((words[partner], -ns[partner], owner))
    own, first, n = np.unique(owner[order], return_index=True, return_counts=True)
    best = partner[order][first]
    text = lambda x: [w.decode("latin-1") for w in words[x].tolist()]
    return pd.DataFrame({"word": text(own), "n_near": n, "best_n": ns[best], "best": text(best)})


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best): words of ``words`` (word, n) with a near word, of which ``best`` has the largest n."""
    blocks = stored(letter_blocks(words, tile), "spelling-blocks")
    sizes = blocks.select(F.col("code").alias("home"), F.col("tiles").alias("home_tiles")).distinct()
    step = F.explode(F.array(*[F.array(*map(F.lit, s)) for s in steps()])).alias("step")
    # a block goes to those homes from which a step leads to it, and a block itself is its own first neighbour
    goes = (blocks.select("code", "tile", "words", "ns", step)
            .withColumn("home", F.zip_with("code", "step", lambda a, b: a - b))
            .withColumn("self", F.col("home") == F.col("code")).join(sizes, "home")
            .withColumn("home_tile", F.explode(F.sequence(F.lit(0), F.col("home_tiles") - 1)))
            .where(~F.col("self") | (F.col("home_tile") <= F.col("tile"))))
    met = goes.groupBy("home", "home_tile", "tile").agg(F.collect_list(
        F.struct("self", F.element_at("code", 1).alias("length"), "words", "ns")).alias("others"))
    own = blocks.select(F.col("code").alias("home"), F.col("tile").alias("home_tile"),
                        F.col("words").alias("home_words"), F.col("ns").alias("home_ns"))
    rows = met.join(own, ["home", "home_tile"]).select(
        F.element_at("home", 1).alias("length"), (F.col("home_tile") == F.col("tile")).alias("same"),
        "home_words", "home_ns", F.col("others.self").alias("self"), F.col("others.length").alias("lengths"),
        F.col("others.words").alias("words"), F.col("others.ns").alias("ns"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for row in pdf.itertuples(index=False):
                yield from block_partners(row)

    found = rows.mapInPandas(run, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
            .select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best")))


def block_partners(row) -> Iterator[pd.DataFrame]:
    """Near pairs of one tile against its neighbours: own tile, same length, one longer."""
    size = int(row.length)
    home, home_ns = matrix(row.home_words, size), np.asarray(row.home_ns)
    n = len(home)
    for gap in (0, 1):
        for inner in ((True, False) if gap == 0 else (False,)):
            # the tile against itself is a part of its own, as only half of its pairs count
            at = [k for k, s in enumerate(row.lengths) if s == size + gap and inner == bool(row.self[k] and row.same)]
            if not at:
                continue
            other = np.concatenate([matrix(row.words[k], size + gap) for k in at])
            i, j = near_pairs(home, other, upper=inner)
            if not len(i):
                continue
            ns = np.concatenate([home_ns, *[np.asarray(row.ns[k]) for k in at]])
            kind = f"S{size + gap}"
            texts = np.concatenate([np.ascontiguousarray(home).view(f"S{size}").ravel().astype(kind),
                                    np.ascontiguousarray(other).view(kind).ravel()])
            yield best_partners(texts, np.concatenate([i, j + n]), np.concatenate([j + n, i]), ns)


# -- forms ------------------------------------------------------------------
def roots(forms: DataFrame) -> DataFrame:
    """(word, root): ``forms`` (word, form) followed to the last, the way doubling with each round."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                          F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dominance: int = DOMINANCE,
                      least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every distinct word."""
    words = stored(word_counts(docs, id_col, text_col, least_length, least_count), "spelling-words")
    form = F.col("best_n") >= dominance * F.col("n")
    rows = stored(words.join(near_words(words, tile), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(form, F.col("best")).alias("form"), F.when(form, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(rows.where("form is not null").select("word", "form"))
    return rows.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same rows in SQL: near words share what is left when one place is taken out. 3988292384 is the polynomial of CRC-32.
ORACLE_SQL = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
times AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, unicode(x) - 64] END))),
    lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1]))) AS h FROM times, crc_table),
thinned AS (
  SELECT CASE WHEN h % {THIN} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM thinned WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
cuts AS (
  SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN cuts b ON b.rest = a.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS best, max(n) AS best_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= {DOMINANCE} * w.n THEN b.best END AS form,
    CASE WHEN b.best_n >= {DOMINANCE} * w.n THEN b.best_n END AS form_n FROM words w LEFT JOIN best b USING (word)),
follow AS (
  SELECT word, word AS at FROM forms UNION ALL SELECT x.word, f.form FROM follow x JOIN forms f ON f.word = x.at WHERE f.form IS NOT NULL),
ends AS (SELECT x.word, x.at AS root FROM follow x JOIN forms f ON f.word = x.at WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM forms f JOIN ends e USING (word)
"""
