"""Document fingerprints by randomised edit embedding.

All texts share one random walk: at step t a walker standing on a character
writes it down, and a random bit of (t, class of the character) says whether it
moves on. Two texts that differ by k edits write sequences whose Hamming
distance is small in k, because the walkers meet again after each edit.
Every character takes at least one step; the bits repeat after ``PERIOD`` steps,
so the walk is a chain of list lookups that runs inside C.

A fingerprint samples the written sequence at shared random steps. Steps have
nested levels (level l keeps a 2^-l share); a text uses the lowest level that
keeps about ``SAMPLES`` steps, so long texts are covered whole. A sample is one
byte of a hash of the ``GRAM`` characters under the walker. The likeness of two
fingerprints is the share of equal samples at the coarser of their levels, over
the longer of the two (0 to 1; two empty texts: 1).

``near_documents`` finds near copies: bands of sampled bytes are joined, and each
candidate is verified once by its likeness. Each byte of a band is drawn from all
samples of a level by shared random ranks (the sample of the smallest rank), so two
texts agree in a byte with probability equal to their likeness, wherever they
differ, and share one of the bands with 1 - (1 - likeness^4)^16 (99.8 % at 0.75).
Links join documents into classes, named by their smallest id (null without any);
equal fingerprints (by a 64-bit key) are one class from the start.

Nulls: a null text is the empty text (fingerprint "0."). A null id sorts first
where documents are ordered. Repeated ids are ordered by text, equal rows stay
separate rows. Other columns are ignored, whatever their names. An empty table
gives an empty result. Texts are used whole; memory is one Arrow batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, islice
from operator import getitem, itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import empty_text, partitions, stored
from .ngram_join import components, first_pairs, joined_labels

SEED, CLASSES, PERIOD, SAMPLES, GRAM = 20_261, 64, 8_191, 256, 3
NEAR = 0.75
BANDS, BAND_BYTES = 16, 4
#: Prints of a band that are compared with others at once, and rows of a band that one group of a task holds.
BLOCK, PART = 256, 8_192
#: Texts are sorted by so many characters before they are packed; longer ties are settled where they are unpacked.
HEAD = 32


class EditWalk:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        moves = rng.integers(0, 2, (PERIOD, CLASSES)).astype(bool)
        steps = np.where(np.vstack([moves, moves]), np.arange(2 * PERIOD)[:, None], 2 * PERIOD)
        after = (np.minimum.accumulate(steps[::-1])[::-1][:PERIOD] + 1) % PERIOD
        self.nodes: list[list] = [[None] * (CLASSES + 1) for _ in range(PERIOD)]
        for t, row in enumerate(after.tolist()):
            node = self.nodes[t]
            node[:CLASSES] = [self.nodes[u] for u in row]
            node[CLASSES] = t
        self.class_mult = np.uint32(0x9E37_79B1)
        self.gram_mult = rng.integers(1, 1 << 62, GRAM).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.step_seed = np.uint64(rng.integers(1, 1 << 62))
        self.levels = np.zeros(0, np.uint8)
        self.at: dict[int, np.ndarray] = {}
        self.lowest = np.zeros((BANDS, BAND_BYTES, 0), np.int64)

    def codes(self, text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)

    def walk(self, codes: np.ndarray, start: int = 0) -> np.ndarray:
        """Step at which each character is reached, then the end; ``start`` is the first."""
        classes = ((codes * self.class_mult) >> np.uint32(26)).astype(np.uint8).tobytes()
        nodes = islice(accumulate(classes, getitem, initial=self.nodes[start % PERIOD]), 1, None)
        t = np.empty(len(codes) + 1, np.int64)
        t[0] = start % PERIOD
        t[1:] = np.fromiter(map(itemgetter(CLASSES), nodes), np.int64, len(codes))
        t[1:] += np.cumsum(np.diff(t) <= 0) * PERIOD
        return t + (start - start % PERIOD)

    def sampled(self, level: int, end: int) -> np.ndarray:
        """The steps below ``end`` that ``level`` keeps."""
        if end > len(self.levels):
            n = max(end, 2 * len(self.levels), 1 << 16)
            x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E37_79B9_7F4A_7C15) ^ self.step_seed
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58_476D_1CE4_E5B9)
            x ^= x >> np.uint64(27)
            low = x & (~x + np.uint64(1))
            self.levels = np.minimum(np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)), 60).astype(np.uint8)
            self.at = {}
        if level not in self.at:
            self.at[level] = np.flatnonzero(self.levels >= level)
        own = self.at[level]
        return own[:np.searchsorted(own, end)]

    def fingerprint(self, codes: np.ndarray, t: np.ndarray) -> tuple[int, bytes]:
        end = int(t[-1])
        level = max(0, int(np.ceil(np.log2(end / SAMPLES)))) if end else 0
        at = self.sampled(level, end)
        i = np.searchsorted(t, at, side="right") - 1
        # no copy of the whole text: only the characters under the samples
        grams = i[:, None] + np.arange(GRAM)
        chars = np.where(grams < len(codes), codes[np.minimum(grams, max(len(codes) - 1, 0))] + 1 if len(codes) else 0, 0)
        h = (chars.astype(np.uint64) * self.gram_mult).sum(axis=1, dtype=np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D0_49BB_1331_11EB)
        return level, (h >> np.uint64(56)).astype(np.uint8).tobytes()

    def likeness(self, a: tuple[int, bytes], b: tuple[int, bytes]) -> float:
        level = max(a[0], b[0])
        x, y = (self.coarse(f, level) for f in (a, b))
        most, both = max(len(x), len(y)), min(len(x), len(y))
        return float((x[:both] == y[:both]).sum() / most) if most else 1.0

    def coarse(self, f: tuple[int, bytes], level: int) -> np.ndarray:
        values = np.frombuffer(f[1], np.uint8)
        if f[0] == level:
            return values
        self.sampled(f[0], 1)
        own = self.at[f[0]]
        if len(own) < len(values):
            self.sampled(f[0], 4 * SAMPLES << f[0])
            own = self.at[f[0]]
        return values[self.levels[own[:len(values)]] >= level]

    def places(self, n: int) -> np.ndarray:
        """Of the first ``n`` samples of a level, the one of the smallest rank for each byte of each band."""
        most = self.lowest.shape[2]
        if n > most:
            most = max(n, 2 * most, 4 * SAMPLES)
            ranks = np.stack([[np.random.default_rng([SEED, b, k]).random(most) for k in range(BAND_BYTES)] for b in range(BANDS)])
            new = ranks == np.minimum.accumulate(ranks, axis=2)
            self.lowest = np.maximum.accumulate(np.where(new, np.arange(most), 0), axis=2)
        return self.lowest[:, :, n - 1]

    def bands(self, f: tuple[int, bytes], threshold: float = NEAR) -> np.ndarray:
        """Keys (level, band, bytes) at the own level and, for a text long enough to be like one of the next level, there."""
        keys = []
        for level in (f[0], f[0] + 1):
            values = self.coarse(f, level)
            # any text of the next level has at least the samples up to its first step count
            if not len(values) or level > f[0] and len(values) < threshold * len(self.sampled(level, (SAMPLES << f[0]) + 1)):
                continue
            own = np.ascontiguousarray(values[self.places(len(values))]).view("<u4")[:, 0].astype(np.int64)
            keys.append(level << 40 | np.arange(BANDS) << 32 | own)
        return np.concatenate(keys) if keys else np.zeros(0, np.int64)


def to_text(f: tuple[int, bytes]) -> str:
    return f"{f[0]:x}.{f[1].hex()}"


def from_text(s: str) -> tuple[int, bytes]:
    level, values = s.split(".")
    return int(level, 16), bytes.fromhex(values)


def from_packed(b: bytes) -> tuple[int, bytes]:
    return b[0], bytes(b[1:])


def packed_print(p: str) -> Column:
    """A fingerprint's text as one byte of its level and the samples."""
    return F.concat(F.unhex(F.lpad(F.substring_index(p, ".", 1), 2, "0")), F.unhex(F.substring_index(p, ".", -1)))


def whole_print(p: str) -> Column:
    digits = F.lower(F.hex(p))
    return F.concat(F.regexp_replace(F.substring(digits, 1, 2), "^0", ""), F.lit("."), F.substring(digits, 3, (1 << 31) - 1))


@F.pandas_udf(T.BinaryType())
def packed_text(texts: pd.Series) -> pd.Series:
    codec = pa.Codec("zstd", compression_level=1)
    raws = (t.encode("utf-8", "surrogatepass") for t in texts)
    return pd.Series([len(r).to_bytes(4, "little") + codec.compress(r, asbytes=True) for r in raws], dtype=object)


def unpacked(packed: bytes) -> bytes:
    return pa.Codec("zstd").decompress(packed[4:], int.from_bytes(packed[:4], "little"), asbytes=True)


def in_text_order(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(doc_id, guest, text) of rows sorted by (guest, sort_key, head), equal ones by their whole texts."""
    held, raws, place = [], {}, None

    def flush() -> Iterator[tuple]:
        if len(held) > 1:
            raws.update((k, unpacked(k)) for k in raws)
            held.sort(key=lambda row: raws[row[2]])
        for doc_id, guest, packed in held:
            yield doc_id, guest, (raws[packed] or unpacked(packed)).decode("utf-8", "surrogatepass")

    for pdf in frames:
        for doc_id, key, head, packed, guest in zip(pdf["doc_id"].astype("Int64"), pdf["sort_key"], pdf["head"], pdf["packed"], pdf["guest"]):
            if (guest, key, head) != place:
                yield from flush()
                held, raws, place = [], {}, (guest, key, head)
            raws.setdefault(packed, None)
            held.append((doc_id, guest, packed))
    yield from flush()


def with_next(src: DataFrame, key: str, others: list[str]) -> DataFrame:
    """Deal rows into ranges of ``key`` that also hold the next range's first rows.

    Adds ``bucket`` and ``guest``. Rows of a bucket are in one partition, by
    (bucket, guest, key, others); the last bucket's guest is the first row of all.
    The driver sees one number a range. The text is shuffled once.
    """
    n = partitions(src)
    cuts = src.agg(F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0]
    bounds = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf(T.IntegerType())
    def bucket_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, k.to_numpy(), side="left").astype(np.int32))

    heads = sorted((r.bucket, r.head) for r in src.groupBy(bucket_of(key).alias("bucket"))
                   .agg(F.min(key).alias("head")).collect())  # one row a range
    first = np.array([h for _, h in heads], np.int64)
    goes_to = np.array([heads[i - 1][0] for i in range(len(heads))], np.int32)

    @F.pandas_udf(T.IntegerType())
    def guest_of(k: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(first, k.to_numpy()), len(first) - 1)
        return pd.Series(np.where(first[at] == k.to_numpy(), goes_to[at], -1).astype(np.int32))

    if not heads:
        return src.withColumns({"bucket": F.lit(0), "guest": F.lit(False)})
    places: Column = F.array(F.struct(bucket_of(key).alias("bucket"), F.lit(False).alias("guest")),
                             F.struct(guest_of(key).alias("bucket"), F.lit(True).alias("guest")))
    dealt = (src.withColumn("places", places)
             .select("*", F.inline(F.filter("places", lambda p: p.bucket >= 0))).drop("places"))
    return dealt.repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions("bucket", "guest", key, *others)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every whole text."""
    src = docs.select(F.col(id_col).alias("doc_id"), empty_text(text_col).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk = EditWalk()
        for pdf in frames:
            out = []
            for text in pdf["text"]:
                codes = walk.codes(text)
                out.append((len(codes), to_text(walk.fingerprint(codes, walk.walk(codes)))))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_chars": [x[0] for x in out],
                                "fingerprint": [x[1] for x in out]})

    return src.mapInPandas(run, f"doc_id {dict(src.dtypes)['doc_id']}, n_chars bigint, fingerprint string")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint each text, and the text whose last quarter is the next document's start."""
    lowest = F.lit(-(1 << 63))
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), empty_text(text_col).alias("text"))
    # texts travel packed; the row sort sees their first characters
    src = src.select("doc_id", F.coalesce("doc_id", lowest).alias("sort_key"), F.substring("text", 1, HEAD).alias("head"),
                     packed_text("text").alias("packed"))
    dealt = with_next(src, "sort_key", ["head"]).select("doc_id", "sort_key", "head", "packed", "guest")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk, ordered = EditWalk(), in_text_order(frames)
        pairs = edited_pairs(walk, ordered)
        while rows := list(islice(pairs, 1_000)):
            yield pd.DataFrame(rows, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint",
                                              "edited_fingerprint", "near_edited", "near_next"]
                               ).astype({"doc_id": "Int64"})

    def edited_pairs(walk: EditWalk, ordered: Iterator[tuple]) -> Iterator[tuple]:
        waiting = None
        for doc_id, guest, text in ordered:
            if guest and waiting is None:
                continue  # another row with the first id of the next range
            codes = walk.codes(text)
            steps = walk.walk(codes)
            print_ = walk.fingerprint(codes, steps)
            if waiting:
                yield edited(walk, waiting, text, codes, print_)
            waiting = None if guest else (doc_id, text, codes, steps, print_)

    def edited(walk, waiting, next_text, next_codes, next_print) -> tuple:
        doc_id, text, codes, steps, print_ = waiting
        cut = len(text) // 4
        kept = len(text) - cut
        new_codes = np.concatenate([codes[:kept], next_codes[:cut]])
        # the walk over the kept part is the same; go on from there
        new_steps = np.concatenate([steps[:kept], walk.walk(next_codes[:cut], int(steps[kept]))])
        new = walk.fingerprint(new_codes, new_steps)
        digest = hashlib.sha256((text[:kept] + next_text[:cut]).encode("utf-8", "surrogatepass")).hexdigest()
        return (doc_id, len(text), digest, to_text(print_), to_text(new),
                walk.likeness(print_, new), walk.likeness(print_, next_print))

    return dealt.mapInPandas(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double")


def padded(values: list[np.ndarray], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Samples as rows of one width, ``fill`` behind each, and their numbers."""
    size = np.array([len(v) for v in values], np.int64)
    out = np.full((len(values), int(size.max(initial=0))), fill, np.int16)
    out[np.arange(out.shape[1]) < size[:, None]] = np.concatenate(values) if values else 0
    return out, size


def likenesses(walk: EditWalk, level: int, a: list[tuple[int, bytes]], b: list[tuple[int, bytes]]) -> np.ndarray:
    """``walk.likeness`` of every print of ``a`` with every one of ``b``, prints of ``level`` or the one below."""
    def table(level: int, a: list, b: list) -> np.ndarray:
        (x, nx), (y, ny) = padded([walk.coarse(f, level) for f in a], -1), padded([walk.coarse(f, level) for f in b], -2)
        both = min(x.shape[1], y.shape[1])
        out = np.empty((len(a), len(b)))
        step = max(1, (1 << 24) // max(1, len(a) * both))
        for k in range(0, len(b), step):
            out[:, k:k + step] = (x[:, None, :both] == y[None, k:k + step, :both]).sum(axis=2)
        most = np.maximum(nx[:, None], ny[None, :])
        return np.where(most > 0, out / np.maximum(most, 1), 1.0)

    out = table(level, a, b)
    i, j = (np.flatnonzero([f[0] < level for f in own]) for own in (a, b))
    if len(i) and len(j):  # both are of the level below: that is where their likeness is taken
        out[np.ix_(i, j)] = table(level - 1, [a[k] for k in i], [b[k] for k in j])
    return out


def cell_links(cells: DataFrame, threshold: float) -> DataFrame:
    """(a, b, likeness) of links that join labels, of rows (shingle, block, part, head, node, label, print).

    The heads of a cell are compared with all its rows, block by block; of the links found, those stay that
    join labels not joined in the cell yet, fewer than its labels.
    """
    key = ["shingle", "block", "part"]
    dealt = cells.repartition(partitions(cells), *key).sortWithinPartitions(*key, F.desc("head"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk, cell, heads, up = EditWalk(), None, None, {}

        def top(x: int) -> int:
            while up.get(x, x) != x:
                x = up[x]
            return x

        for pdf in frames:
            out, places = [], pdf[key].to_numpy()
            all_prints, nodes, labels, is_head = [from_packed(x) for x in pdf["print"]], *(pdf[c].to_numpy() for c in ("node", "label", "head"))
            starts = np.flatnonzero(np.append(True, (places[1:] != places[:-1]).any(axis=1))[:len(pdf)]).tolist()
            for begin, end in zip(starts, [*starts[1:], len(pdf)]):
                own = tuple(places[begin].tolist())
                prints, node, label = all_prints[begin:end], nodes[begin:end], labels[begin:end]
                if own != cell:
                    cell, heads, up = own, ([], node[:0], label[:0]), {}
                n = int(is_head[begin:end].sum())
                heads = (heads[0] + prints[:n], np.append(heads[1], node[:n]), np.append(heads[2], label[:n]))
                if not heads[0]:
                    continue
                like = likenesses(walk, own[0] >> 40, heads[0], prints)
                i, j = np.nonzero((like >= threshold) & (heads[2][:, None] != label[None, :]))
                _, first = np.unique(np.stack([heads[2][i], label[j]], axis=1), axis=0, return_index=True)
                for k in first.tolist():
                    x, y = top(heads[2][i[k]]), top(label[j[k]])
                    if x != y:
                        up[x] = y
                        a, b = heads[1][i[k]], node[j[k]]
                        out.append((min(a, b), max(a, b), like[i[k], j[k]]))
            if out:
                yield pd.DataFrame(out, columns=["a", "b", "likeness"])

    return dealt.mapInPandas(run, "a bigint, b bigint, likeness double")


def linked_prints(prints: DataFrame, threshold: float = NEAR) -> tuple[DataFrame, DataFrame]:
    """(a, b, likeness) of verified links and (node, label) of the linked prints, by ``key``, of (key, fingerprint packed).

    A band is ``BAND_BYTES`` sampled bytes at shared places all over the text; a text gives
    its bands at its own level and the next, so that lengths near a level's edge still meet.
    Of a band's prints the first is paired with every other. In bands whose prints then lie in
    different components, the next ``BLOCK`` prints are compared with all others; at last, among the prints
    behind these, all outside the band's largest component with all. A row travels once a block of such prints,
    not once a pair.
    """
    def bands(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk, seen = EditWalk(), set()
        for pdf in frames:
            own = pdf[np.array([k not in seen and not seen.add(k) for k in pdf["key"].tolist()], bool)]
            keys = [walk.bands(from_packed(b), threshold) for b in own["fingerprint"]]
            if keys:
                yield pd.DataFrame({"shingle": np.concatenate(keys), "node": own["key"].repeat([len(k) for k in keys]), "place": 1 << 32})

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk = EditWalk()
        for pdf in frames:
            like = [walk.likeness(from_packed(a), from_packed(b)) for a, b in zip(pdf["print_a"], pdf["print_b"])]
            yield pdf[["a", "b"]].assign(likeness=like)

    met = stored(first_pairs(prints.mapInPandas(bands, "shingle bigint, node bigint, place bigint")), "edit-met")
    pairs = met.where("kind = 0").select("a", "b").distinct()
    # a row a print with its bands, few for each: labels are joined to prints, not to bands
    open_prints = stored(met.where("kind = 1").groupBy(F.col("a").alias("node"))
                         .agg(F.collect_list(F.struct("shingle", "idx")).alias("bands")), "edit-open")
    involved = met.select(F.explode(F.when(F.col("kind") == 0, F.array("a", "b")).otherwise(F.array("a"))).alias("key")).distinct()
    wanted = stored(prints.join(involved, "key", "left_semi").dropDuplicates(["key"]), "edit-prints")

    def prints_of(x: str, name: str) -> DataFrame:
        # prints are shuffled at every size, never broadcast
        return wanted.select(F.col("key").alias(x), F.col("fingerprint").alias(name)).hint("merge")

    links = stored(pairs.join(prints_of("a", "print_a"), "a").join(prints_of("b", "print_b"), "b")
                   .mapInPandas(verify, "a bigint, b bigint, likeness double").where(F.col("likeness") >= threshold), "edit-links")
    labels = components(links.select("a", "b"))
    own_part = F.pmod(F.xxhash64("node"), F.col("n_parts"))
    for last in (False, True):
        # the first prints of a band are compared with all before, so the rest among themselves is left
        rows = (open_prints.join(labels, "node", "left")
                .select("node", F.coalesce("label", "node").alias("label"), F.inline("bands"))
                .where(f"idx > {BLOCK if last else 0}"))
        sizes = (rows.groupBy("shingle", "label").count().groupBy("shingle")
                 .agg(F.max_by("label", F.struct("count", "label")).alias("most"), F.sum("count").alias("n"), F.max("count").alias("m"))
                 .where("m < n").select("shingle", "most", F.ceil(F.col("n") / PART).alias("n_parts"),
                                        F.ceil((F.col("n") - F.col("m")) / BLOCK if last else F.lit(1)).alias("n_blocks")))
        rows = rows.join(sizes, "shingle").withColumns({
            "is_head": F.col("label") != F.col("most") if last else F.col("idx") <= BLOCK,
            "own_block": F.pmod(F.xxhash64("node", "shingle"), F.col("n_blocks")), "own_part": own_part})
        rows = stored(rows.select("shingle", "node", "label", "is_head", "n_blocks", "n_parts", "own_block", "own_part"), "edit-open")
        if rows.isEmpty():
            continue
        cells = F.expr("""concat(
            transform(filter(sequence(0L, n_parts - 1), p -> is_head),
                      p -> struct(own_block as block, p as part, true as head)),
            transform(filter(sequence(0L, n_blocks - 1), b -> not is_head or b <> own_block),
                      b -> struct(b as block, own_part as part, false as head)))""")
        found = stored(cell_links(rows.join(prints_of("node", "print"), "node")
                                  .select("shingle", "node", "label", "print", F.inline(cells)), threshold), "edit-links")
        if not found.isEmpty():
            links, labels = links.unionByName(found), joined_labels(labels, found.select("a", "b"))
    return links, labels


def near_classes(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, near_class) of prints that are linked or repeat: the smallest id of the component of ``rows`` (doc_id, key)."""
    keys = (rows.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
            .join(labels.withColumnRenamed("node", "key"), "key", "left").where("n > 1 or label is not null")
            .select("key", "least", F.coalesce("label", "key").alias("label")))
    best = keys.groupBy("label").agg(F.min("least").alias("near_class"))
    return stored(keys.join(best, "label").select("key", "near_class"), "edit-classes")


def with_near_class(rows: DataFrame, threshold: float = NEAR) -> DataFrame:
    """``rows`` (doc_id, key, fingerprint, ...; read twice) with ``near_class``, the smallest id of the row's component."""
    _, labels = linked_prints(rows.select("key", "fingerprint"), threshold)
    classes = near_classes(rows, labels).withColumn("_in", F.lit(True))
    return rows.join(classes, "key", "left").withColumn(
        "near_class", F.when(F.col("_in"), F.col("near_class")).otherwise(F.col("doc_id"))).drop("_in")


def classed_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``edited_fingerprints`` with ``near_class``: the banded and verified class of every document.

    The rows wait in the shared folder, and meet their classes, with hex digits packed.
    """
    prints = ["fingerprint", "edited_fingerprint"]
    rows = edited_fingerprints(docs, id_col, text_col).withColumn("key", F.xxhash64("fingerprint"))
    rows = stored(rows.withColumns({p: packed_print(p) for p in prints} | {"edited_sha256": F.unhex("edited_sha256")}), "edit-rows")
    whole = {p: whole_print(p) for p in prints} | {"edited_sha256": F.lower(F.hex("edited_sha256"))}
    return with_near_class(rows).drop("key").withColumns(whole)


def near_members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = NEAR) -> DataFrame:
    """(doc_id, near_class) of every document; exact copies are in one class."""
    prints = stored(fingerprints(docs, id_col, text_col).withColumn("key", F.xxhash64("fingerprint"))
                    .withColumn("fingerprint", packed_print("fingerprint")), "edit-rows")
    return with_near_class(prints, threshold).select("doc_id", "near_class")


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = NEAR) -> DataFrame:
    """(doc_id, near_id, likeness): verified links between the smallest ids of equal fingerprints.

    The links join every component; pairs inside a component are not all among them.
    """
    prints = stored(fingerprints(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
                    .groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
                    .withColumn("key", F.xxhash64("fingerprint")).withColumn("fingerprint", packed_print("fingerprint")), "edit-rows")
    links, _ = linked_prints(prints.select("key", "fingerprint"), threshold)
    a, b = (prints.select(F.col("key").alias(x), F.col("doc_id").alias(f"id_{x}")) for x in "ab")
    return links.join(a, "a").join(b, "b").select(
        F.greatest("id_a", "id_b").alias("doc_id"), F.least("id_a", "id_b").alias("near_id"), "likeness")
