"""N-gram Jaccard self-join by rare-first prefix filtering.

A document's set holds its distinct 5-word shingles (64-bit hashes; ASCII letters
lower-cased; with fewer words the whole sequence is one shingle; without words
the set is empty and linked with nothing). Two documents link when
``100 * |a n b| >= 75 * |a u b|``.

1. One pass hashes the sets. Documents with equal sets are one class from here
   on (a 64-bit key of the set), so groups of exact copies are never paired. Each task also
   reports shingles that it meets in two or more classes; the ``HEAVY`` most
   frequent of them are the order's tail. Any common order is correct; this one
   is rare-first, as shingles outside the list are rarer.
2. A second pass sends each set's prefix, its first n - ceil(0.75 n) + 1
   shingles in (frequency, hash) order, dealt and sorted by shingle. Linked sets share one of
   them. A task sends a class once.
3. Of the classes that share a prefix shingle, the first is paired with every
   other, after the length and positional filters. Rows stream; nothing is
   gathered. Shingles with two classes are finished by that.
4. Pairs are made distinct and verified once: the suffix filter (the sets' counts
   in ``PIVOTS`` hash ranges bound their Hamming distance), which moves no text,
   then the exact intersection of the two texts' sets. The texts are dealt by
   class once, as a bucketed table, so no round of pairs moves them all again.
5. Shingles with three or more classes go on while their classes lie in different
   components: the next 3, 12, 48, ... classes in order are paired with the later ones
   of other components, so every pair that could still join two components is
   verified, and pairs inside a component are not. No cap is set.

Components come from contracting links by smallest label, with tables in the
shared folder in between.

Nulls: null texts have empty sets; null ids get a row, take part in links, and
are never a component's id unless it has no other (then null). Repeated rows and ids are
separate rows of one component if their sets are equal or linked. Extra columns
are ignored, whatever their names. Empty tables give empty results. Texts are
used whole. Key collisions have probability about (classes^2) / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, frequent, partitions, rebatch, stored

WORDS = 5
SHARE = 75  # of 100
HEAVY = 1 << 18
BATCH_CHARS, COUNTED = 2_000_000, 4_000_000
PIVOTS = 256
GROWTH = 4

RNG = np.random.default_rng(9)
BYTE = RNG.integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(RNG.integers(1 << 60, 1 << 62)) * 2 + 1
PLACE = RNG.integers(0, 1 << 63, WORDS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
PRIME = (1 << 31) - 1
BYTE_31 = RNG.integers(1, PRIME, 256).astype(np.uint64)
BASE_31 = int(RNG.integers(1 << 29, 1 << 30))
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58_476D_1CE4_E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D0_49BB_1331_11EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def residues(x: np.ndarray) -> np.ndarray:
    """Below 2^31 + 1 and equal to ``x`` < 2^62 modulo ``PRIME``."""
    for _ in range(2):
        x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return x


def prime_powers(base: int, n: int) -> np.ndarray:
    """Powers modulo ``PRIME``, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % np.uint64(PRIME)])
    return out[:n]


class Shingler:
    """Hashes words and shingles. A word's hash mixes its length with two polynomials of its bytes, one modulo
    2^64 and one modulo a prime: words built to agree in the first for any base differ in the second."""

    def __init__(self) -> None:
        self.up = self.down = self.up_31 = self.down_31 = np.ones(1, np.uint64)

    def words(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(document of each word, hash of each word) over all texts."""
        buf = np.frombuffer(b" " + b" ".join(raws) + b" ", np.uint8)
        space = SPACE[buf]
        starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        if len(buf) > len(self.up):
            self.up = powers(BASE, len(buf))
            self.down = powers(pow(BASE, -1, 1 << 64), len(buf))
            self.up_31 = prime_powers(BASE_31, len(buf))
            self.down_31 = prime_powers(pow(BASE_31, -1, PRIME), len(buf))
        low = LOWER[buf]
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(BYTE[low] * self.up[:len(buf)], out=sums[1:])
        h = mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        np.cumsum(residues(BYTE_31[low] * self.up_31[:len(buf)]), out=sums[1:])
        second = (sums[ends] - sums[starts]) % np.uint64(PRIME) * self.down_31[starts] % np.uint64(PRIME)
        h = mixed(h + second * np.uint64(0x9E37_79B9_7F4A_7C15))
        first = 1 + np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])[:-1]]) if raws else np.zeros(0, np.int64)
        return np.searchsorted(first, starts, side="right") - 1, h

    def sets(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(document, shingle hash), distinct, sorted by document and hash."""
        doc, word = self.words(raws)
        n = len(word)
        if not n:
            return doc, word
        count = np.bincount(doc, minlength=len(raws))
        grams = np.zeros(n, np.uint64)
        for k in range(WORDS):  # words beyond a short text's end add nothing
            at = np.arange(k, n)
            same = doc[at] == doc[at - k]
            grams[(at - k)[same]] += word[at[same]] * PLACE[k]
        begin = np.append(True, doc[1:] != doc[:-1])
        full = np.arange(n) + WORDS <= np.repeat(np.flatnonzero(begin) + count[doc[begin]], count[doc[begin]])
        keep = full | (begin & (count[doc] < WORDS))
        short = np.where(full, 0, count[doc]).astype(np.uint64)
        d, h = doc[keep], mixed(grams + short * np.uint64(0x9E37_79B9_7F4A_7C15))[keep]
        order = np.lexsort((h, d))
        d, h = d[order], h[order]
        new = np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1]))
        return d[new], h[new]


def set_keys(d: np.ndarray, h: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, key) of each document's set; the key of an empty set is 0."""
    size = np.bincount(d, minlength=n_docs)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h + np.uint64(0x51)), dtype=np.uint64)])
    stop = np.cumsum(size)
    key = mixed(sums[stop] - sums[stop - size] + size.astype(np.uint64))
    return size, np.where(size > 0, key, np.uint64(0)).view(np.int64)


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest intersection of linked sets of these sizes: ceil(75 (a + b) / 175)."""
    return -(-SHARE * (a + b) // (100 + SHARE))


def batches(frames: Iterator[pd.DataFrame], seen: set | None = None):
    """(ids, sizes, keys, d, h) of batches of texts; with ``seen``, d and h hold new classes only."""
    shingler = Shingler()
    for pdf in rebatch(frames, "text", BATCH_CHARS):
        raws = [t.encode("utf-8", "surrogatepass") for t in pdf["text"]]
        d, h = shingler.sets(raws)
        size, key = set_keys(d, h, len(raws))
        if seen is not None:
            new = np.zeros(len(raws), bool)
            for i, k in enumerate(key.tolist()):
                if k not in seen:
                    seen.add(k)
                    new[i] = True
            own = new[d]
            d, h = d[own], h[own]
        yield pdf["doc_id"], size, key, d, h


def classes_and_counts(src: DataFrame) -> DataFrame:
    """kind 0: (doc_id, n, key) of each document; kind 1: (key = shingle, n = classes) met twice in a task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        held, total = [], 0

        def heavy() -> pd.DataFrame:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"kind": 1, "doc_id": None, "n": n[n > 1], "key": h[n > 1].view(np.int64)})

        for ids, size, key, _, h in batches(frames, seen):
            yield pd.DataFrame({"kind": 0, "doc_id": ids, "n": size, "key": key})
            held.append(h)
            total += len(h)
            if total >= COUNTED:
                yield heavy()
                held, total = [], 0
        if held:
            yield heavy()

    return src.mapInPandas(run, "kind int, doc_id bigint, n bigint, key bigint")


def most_frequent(met: DataFrame) -> np.ndarray:
    """The most frequent shingles by rising frequency, at most ``HEAVY``."""
    top, _ = frequent(stored(met.groupBy("key").agg(F.sum("n").alias("n")), "join-counts"), "n", HEAVY)
    top = top.toPandas().sort_values(["n", "key"], ascending=[True, False])  # bounded by HEAVY
    return top["key"].to_numpy(np.int64).view(np.uint64)


def prefixes(src: DataFrame, heavy) -> DataFrame:
    """(shingle, node, place): place = size << 32 | position in the order. ``heavy``: a broadcast list by rising frequency."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order = np.argsort(heavy.value)
        by_hash, rank = heavy.value[order], (order + 1).astype(np.int64)
        for _, size, key, d, h in batches(frames, set()):
            if not len(d):
                continue
            if len(by_hash):
                at = np.minimum(np.searchsorted(by_hash, h), len(by_hash) - 1)
                freq = np.where(by_hash[at] == h, rank[at], 0)
                if freq.any():
                    own = np.argsort(d * (len(by_hash) + 1) + freq, kind="stable")
                    d, h = d[own], h[own]
            begin = np.append(True, d[1:] != d[:-1])
            pos = np.arange(len(d)) - np.maximum.accumulate(np.where(begin, np.arange(len(d)), 0))
            n = size[d]
            keep = pos <= n + -SHARE * n // 100  # n - ceil(0.75 n)
            yield pd.DataFrame({"shingle": h[keep].view(np.int64), "node": key[d[keep]], "place": n[keep] << 32 | pos[keep]})

    return src.mapInPandas(run, "shingle bigint, node bigint, place bigint")


def may_link(pa: np.ndarray, pb: np.ndarray) -> np.ndarray:
    """Length and positional filters of two places of a shared shingle.

    The bound holds at the first shingle that two sets share in the order, since
    nothing before it is shared; linked pairs are met there, so later ones may fail it.
    """
    na, nb, i, j = pa >> 32, pb >> 32, pa & 0xFFFFFFFF, pb & 0xFFFFFFFF
    long_enough = 100 * np.minimum(na, nb) >= SHARE * np.maximum(na, nb)
    return long_enough & (1 + np.minimum(na - i - 1, nb - j - 1) >= least_overlap(na, nb))


def first_pairs(postings: DataFrame) -> DataFrame:
    """kind 0: (a, b) pairs of a shingle's first class with its others; kind 1: rows of shingles with three or more."""
    dealt = postings.repartition(partitions(postings), "shingle").sortWithinPartitions("shingle", "place", "node")
    columns = ["kind", "shingle", "a", "b", "place", "idx"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the run that the last batch ended in: its first two rows, its number of classes, its last class
        run_h, first, n_run, last = None, [], 0, None
        for pdf in frames:
            h, node, place = (pdf[c].to_numpy(np.int64) for c in ("shingle", "node", "place"))
            new = np.append(True, (h[1:] != h[:-1]) | (node[1:] != node[:-1]))
            if len(h) and h[0] == run_h and node[0] == last:
                new[0] = False
            h, node, place = h[new], node[new], place[new]
            if not len(h):
                continue
            goes_on = h[0] == run_h
            begin = np.append(not goes_on, h[1:] != h[:-1])
            if goes_on:  # put the run's first rows back in front
                back = len(first)
                h = np.concatenate([np.full(back, run_h), h])
                node = np.concatenate([[x[0] for x in first], node]).astype(np.int64)
                place = np.concatenate([[x[1] for x in first], place]).astype(np.int64)
                begin = np.concatenate([[True], np.zeros(back - 1, bool), begin])
                skipped = n_run - back
            else:
                back = skipped = 0
            start = np.flatnonzero(begin)
            run_of = np.cumsum(begin) - 1
            idx = np.arange(len(h)) - start[run_of]
            total = np.diff(np.append(start, len(h)))[run_of]
            own = run_of == 0
            total = total + np.where(own, skipped, 0)
            idx = idx + np.where(own & (np.arange(len(h)) >= back), skipped, 0)
            fresh = np.arange(len(h)) >= back
            center = start[run_of]
            ok = fresh & (idx > 0)
            ok[ok] = may_link(place[center[ok]], place[ok])
            # rows put back were sent already if the run had three classes by then
            multi = (total >= 3) & (fresh | (n_run < 3))
            yield pd.concat([
                pd.DataFrame({"kind": 0, "shingle": 0, "a": np.minimum(node[center[ok]], node[ok]),
                              "b": np.maximum(node[center[ok]], node[ok]), "place": 0, "idx": 0}, columns=columns),
                pd.DataFrame({"kind": 1, "shingle": h[multi], "a": node[multi], "b": 0, "place": place[multi], "idx": idx[multi]},
                             columns=columns)])
            tail = run_of == run_of[-1]
            run_h, last, n_run = h[-1], node[-1], int(total[-1])
            first = list(zip(node[tail][:2].tolist(), place[tail][:2].tolist()))

    return dealt.mapInPandas(run, "kind int, shingle bigint, a bigint, b bigint, place bigint, idx bigint")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact test; sets sorted by hash."""
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum()) >= int(least_overlap(len(a), len(b)))


def counts_by_range(d: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """Shingles of each set in each of ``PIVOTS`` ranges of hashes, at most 255."""
    at = d * PIVOTS + (h >> np.uint64(64 - PIVOTS.bit_length() + 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=n_docs * PIVOTS), 255).astype(np.uint8).reshape(n_docs, PIVOTS)


def suffix_filtered(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose sets may be close enough: the ranges' counts bound the Hamming distance from below."""
    sides = [texts.select(F.col("key").alias(x), F.col("n").alias(f"n_{x}"), F.col("ranges").alias(f"ranges_{x}")) for x in "ab"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if not len(pdf):
                continue
            x, y = (np.frombuffer(b"".join(pdf[f"ranges_{s}"]), np.uint8).reshape(-1, PIVOTS).astype(np.int16) for s in "ab")
            na, nb = pdf["n_a"].to_numpy(), pdf["n_b"].to_numpy()
            yield pdf.loc[np.abs(x - y).sum(axis=1) <= na + nb - 2 * least_overlap(na, nb), ["a", "b"]]

    return pairs.join(sides[0], "a").join(sides[1], "b").mapInPandas(run, "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) that link; the two texts of a pair that passes the suffix filter meet in one row."""
    left = stored(suffix_filtered(pairs, texts), "join-left")
    rows = (left.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for pdf in rebatch(frames, "text_a", BATCH_CHARS // 2):
            places = {t: i for i, t in enumerate(dict.fromkeys([*pdf["text_a"], *pdf["text_b"]]))}
            sets: list[np.ndarray] = []
            held, size = [], 0
            for t in [*places, None]:  # None: hash what is left
                if t is None or size + len(t) > BATCH_CHARS:
                    d, h = shingler.sets(held)
                    sets += np.split(h, np.cumsum(np.bincount(d, minlength=len(held)))[:-1]) if held else []
                    held, size = [], 0
                if t is not None:
                    held.append(t.encode("utf-8", "surrogatepass"))
                    size += len(t)
            ok = [linked(sets[places[x]], sets[places[y]]) for x, y in zip(pdf["text_a"], pdf["text_b"])]
            yield pdf.loc[ok, ["a", "b"]]

    return rows.mapInPandas(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest reachable label by contraction; ``links`` has a <> b."""
    links = stored(links.distinct(), "join-links")
    labels = None
    while not links.isEmpty():
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
                    .select("node", F.least("node", "up").alias("up")), "join-up")
        # one jump ahead shortens chains
        up = stored(up.join(up.select(F.col("node").alias("up"), F.col("up").alias("upper")), "up").select(
            "node", F.least("up", "upper").alias("up")), "join-up")
        labels = stored(up.select("node", F.col("up").alias("label")) if labels is None else
                        labels.join(up.select(F.col("node").alias("label"), "up"), "label", "left")
                        .select("node", F.coalesce("up", "label").alias("label")), "join-labels")
        a, b = up.select(F.col("node").alias("a"), F.col("up").alias("up_a")), up.select(F.col("node").alias("b"), F.col("up").alias("up_b"))
        links = stored(links.join(a, "a").join(b, "b").where("up_a <> up_b")
                       .select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct(), "join-links")
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("label"))


def joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more ``links``: only the labels that these join are contracted."""
    a, b = (labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab")
    up = components(links.join(a, "a", "left").join(b, "b", "left")
                    .select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).where("a <> b"))
    moved = (labels.join(up.select(F.col("node").alias("label"), F.col("label").alias("up")), "label", "left")
             .select("node", F.coalesce("up", "label").alias("label")))
    return stored(moved.unionByName(up.join(labels, "node", "left_anti")), "join-labels")


def similar_classes(src: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, key) of every document, and (node, label) of the linked classes."""
    spark = src.sparkSession
    passed = stored(classes_and_counts(src), "join-classes")
    docs = passed.where("kind = 0").select("doc_id", "n", "key")
    heavy = spark.sparkContext.broadcast(most_frequent(passed.where("kind = 1")))
    met = stored(first_pairs(prefixes(src, heavy)), "join-met")
    pairs = stored(met.where("kind = 0").select("a", "b").distinct(), "join-pairs")
    open_rows = met.where("kind = 1").select("shingle", F.col("a").alias("node"), "place", "idx")
    involved = (pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))
                .unionByName(open_rows.select(F.col("node").alias("key"))).distinct())
    wanted = docs.join(involved, "key").groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("rep"))
    wanted = wanted.select("key", F.col("rep.doc_id").alias("rep_id"))
    texts = src.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("key", "text")

    def own_key(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows that share the representative's id but not its set go."""
        shingler = Shingler()
        for pdf in rebatch(frames, "text", BATCH_CHARS):
            d, h = shingler.sets([t.encode("utf-8", "surrogatepass") for t in pdf["text"]])
            n, key = set_keys(d, h, len(pdf))
            ranges = [r.tobytes() for r in counts_by_range(d, h, len(pdf))]
            yield pdf.assign(n=n, ranges=ranges)[key == pdf["key"].to_numpy()]

    found = (texts.mapInPandas(own_key, "key bigint, text string, n bigint, ranges binary")
             .repartition(partitions(src), "key").dropDuplicates(["key"]))  # equal sets of one id with other texts
    with bucketed(found, "key", "join-texts") as texts:
        return docs, linked_classes(pairs, open_rows, texts)


def linked_classes(pairs: DataFrame, open_rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, label) of the linked classes, written; ``open_rows``: the shingles with three or more classes."""
    labels = components(stored(verified(pairs, texts), "join-edges"))
    lo = 1
    while True:
        rows = open_rows.join(labels, "node", "left").select("shingle", "node", "place", "idx", F.coalesce("label", "node").alias("label"))
        apart = (rows.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max("idx").alias("z"))
                 .where(f"x <> y and z > {lo}").select("shingle"))
        rows = stored(rows.join(apart, "shingle", "left_semi"), "join-open")
        if rows.isEmpty():
            return labels
        heads = rows.where(f"idx >= {lo} and idx < {GROWTH * lo}").select(
            "shingle", F.col("node").alias("h_node"), F.col("place").alias("h_place"), F.col("idx").alias("h_idx"), F.col("label").alias("h_label"))
        na, nb = F.shiftright("place", 32), F.shiftright("h_place", 32)
        i, j = F.col("place").bitwiseAND(0xFFFFFFFF), F.col("h_place").bitwiseAND(0xFFFFFFFF)
        near = ((100 * F.least(na, nb) >= SHARE * F.greatest(na, nb))
                & ((100 + SHARE) * (1 + F.least(na - i - 1, nb - j - 1)) >= SHARE * (na + nb)))
        more = (heads.join(rows, "shingle").where((F.col("idx") > F.col("h_idx")) & (F.col("label") != F.col("h_label")) & near)
                .select(F.least("node", "h_node").alias("a"), F.greatest("node", "h_node").alias("b")).distinct()
                .join(pairs, ["a", "b"], "left_anti"))
        more = stored(more, "join-pairs")
        pairs = pairs.unionByName(more)
        if not more.isEmpty():
            edges = stored(verified(more, texts), "join-edges")
            if not edges.isEmpty():
                labels = joined_labels(labels, edges)
        open_rows, lo = rows.drop("label"), GROWTH * lo


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).cast("string").alias("text"))
    rows, labels = similar_classes(src)
    keys = (rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
            .join(labels.withColumnRenamed("node", "key"), "key", "left")
            .select("key", "least", F.coalesce("label", "key").alias("label")))
    best = keys.groupBy("label").agg(F.min("least").alias("component"))
    of_key = keys.join(best, "label").select("key", "component")
    return (rows.join(of_key, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents (all columns) of which one stays a component: the smallest id, null ids last, then the smallest text hash.

    A row counts, not its id: other texts of the same id stay or go by their own component.
    Documents without words link with nothing and stay, but of those equal in id and text one.
    """
    odd = docs.groupBy(F.col(id_col).alias("id")).count().where("id is null or count > 1")
    if odd.isEmpty():
        found = stored(joined(docs, id_col, text_col), "join-found")
        gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone_id"))
        return docs.join(gone, F.col(id_col) == F.col("_gone_id"), "left_anti")
    # repeated or missing ids: the same by row numbers, which are fixed once written
    rows = stored(docs.withColumn("_each_row", F.monotonically_increasing_id()), "join-rows")
    found = stored(joined(rows, "_each_row", text_col), "join-found").select(
        F.col("doc_id").alias("row"), (F.col("n_shingles") > 0).alias("linkable"), "component_id")
    order = rows.select(F.col("_each_row").alias("row"), F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                        F.xxhash64(text_col).alias("text"))
    ranked = order.join(found, "row")
    first = F.min(F.struct("no_id", "id", "text", "row")).alias("first")
    linked = ranked.where("linkable").groupBy("component_id").agg(first).select("first.row")
    blank = ranked.where("not linkable and not no_id").groupBy("id", "text").agg(F.min("row").alias("row")).select("row")
    nameless = ranked.where("not linkable and no_id").select("row")
    stay = linked.unionByName(blank).unionByName(nameless).select(F.col("row").alias("_stay_row"))
    return (rows.join(stay, F.col("_each_row") == F.col("_stay_row"), "left_semi")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


#: The same rows in SQL on the shingles themselves; for small tables.
ORACLE_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda t: t <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {WORDS} THEN [array_to_string(ws, ' ') || ' #']
    ELSE list_transform(range(1, len(ws) - {WORDS} + 2), lambda i: array_to_string(ws[i:i + {WORDS} - 1], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * both_n >= {SHARE} * (a.n + b.n - both_n)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""
