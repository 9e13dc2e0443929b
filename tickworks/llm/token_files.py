"""Token-id files in Simple-8b word-aligned coding.

A file holds whole documents in order. Layout (little-endian 64-bit words):

* header: magic, number of documents, number of ids, number of blocks, number
  of data words;
* per document: its id, its number of ids (an end id included), 1 if the id is null;
* per block of ``BLOCK`` ids: the offset of its first data word;
* data words. Of each word the top 4 bits are the selector; selectors 2 to 15
  pack the counts and widths of ``COUNTS``, selector 1 stands for 120 zeros, and
  selector 0 is the escape: the next word holds one id of more than 60 bits whole.

Every block starts a new word, so blocks decode on their own; within a block all
words of one selector are unpacked at once.

``write_token_files`` sorts documents by id into ranges (one exchange), encodes
each range in one pass and writes a file per range; a retried task writes the
same file under a temporary name and renames it. ``read_token_files`` reads
them back, one task per file.

Nulls: a null text is the empty text (its only id is the end id); null doc_ids
sort first. Repeated ids are ordered by text; equal rows stay separate documents.
Other columns are ignored. An empty table gives no files and an empty result.
Very long texts stay whole; memory is one range's ids.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, compress, count, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickworks.session import work_dir

from .bpe import byte_alphabet
from .common import empty_text, partitions

MAGIC = 0x5338_4944_5331_0001
BLOCK = 65_536
CACHE_CHUNKS, BATCH_CHARS = 300_000, 4_000_000
#: New words that go to the library as one text.
JOINED_CHUNKS = 16_384
#: The driver samples rows' sort keys for the range bounds, so a key holds a text's beginning only; order within a range is by whole texts.
BOUND_CHARS = 64
#: Runs that are put in order at once.
GATHERED = 32_768
#: What the library's pattern takes for white space, as a class of Arrow's regular expressions.
WHITE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WHITE = "[^" + WHITE[1:]
#: Marks that are a piece of their own behind letters, and the words that are always kept, in the order of ``distinct_ids``.
MARKS = ".,;:!?"
FIXED = ["", "\n", *MARKS]
#: Fixed values of the coding: ids per word by selector; the width is 60 // count.
COUNTS = {2: 60, 3: 30, 4: 20, 5: 15, 6: 12, 7: 10, 8: 8, 9: 7, 10: 6, 11: 5, 12: 4, 13: 3, 14: 2, 15: 1}
ZEROS = 120
#: The largest id of each coding, narrowest first, and which coding small ids need.
TOPS = np.array([0, *((1 << (60 // c)) - 1 for c in COUNTS.values())], np.uint64)
NEED = np.searchsorted(TOPS, np.arange(1 << 16, dtype=np.uint64)).astype(np.uint8)


# -- coding ---------------------------------------------------------------
def pack_block(ids: np.ndarray) -> np.ndarray:
    """Data words of one block of unsigned 64-bit ids."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    # the narrowest coding of each id; behind the block anything fits, so a short last word is padded with zeros
    need = np.zeros(n + ZEROS, np.uint8)
    need[:n] = NEED[np.minimum(ids, np.uint64(len(NEED) - 1)).view(np.int64)]
    large = np.flatnonzero(ids >= np.uint64(len(NEED)))
    need[large] = np.searchsorted(TOPS, ids[large])
    selector = np.zeros(n, np.uint8)
    wide, size = need, 1  # the widest of ``size`` ids from each place on
    for sel, count in reversed([(1, ZEROS), *COUNTS.items()]):
        while 2 * size <= count:
            wide, size = np.maximum(wide[:-size], wide[size:]), 2 * size
        ok = np.maximum(wide[:n], wide[count - size:count - size + n]) < sel
        if sel == 1:  # only whole runs of zeros
            ok[max(0, n - ZEROS + 1):] = False
        selector[ok] = sel
    counts = np.zeros(16, np.int64)
    counts[0], counts[1] = 1, ZEROS
    for s, c in COUNTS.items():
        counts[s] = c
    step, starts, i = counts.astype(np.uint8)[selector].tobytes(), bytearray(n), 0
    while i < n:  # one step a word, not an id
        starts[i] = 1
        i += step[i]
    at = np.flatnonzero(np.frombuffer(starts, np.uint8))
    sels = selector[at]
    extra = sels == 0
    word_at = np.arange(len(at)) + np.concatenate([[0], np.cumsum(extra)[:-1]])
    out = np.zeros(len(at) + int(extra.sum()), np.uint64)
    out[word_at] = sels.astype(np.uint64) << np.uint64(60)
    out[word_at[extra] + 1] = ids[at[extra]]
    padded = np.concatenate([ids, np.zeros(64, np.uint64)])
    for s, c in COUNTS.items():
        own = np.flatnonzero(sels == s)
        if len(own):
            word, first = out[word_at[own]], at[own]
            for k in range(c):
                word |= padded[first + k] << np.uint64(60 // c * k)
            out[word_at[own]] = word
    return out


def unpack_block(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of one block's words."""
    sels = (words >> np.uint64(60)).astype(np.int64)
    if (sels == 0).any():  # words after an escape are ids, not headers
        head = np.ones(len(words), bool)
        for i in np.flatnonzero(sels == 0).tolist():
            if head[i]:
                if i + 1 == len(words):
                    raise ValueError("token file: an escape without its word")
                head[i + 1] = False
    else:
        head = np.ones(len(words), bool)
    counts = np.zeros(16, np.int64)
    counts[0], counts[1] = 1, ZEROS
    for s, c in COUNTS.items():
        counts[s] = c
    at = np.flatnonzero(head)
    own_sel = sels[at]
    ends = np.cumsum(counts[own_sel])
    begins = ends - counts[own_sel]
    if not len(at) or begins[-1] >= n or ends[-1] < n:
        raise ValueError("token file: a block's words do not hold its number of ids")
    out = np.zeros(int(ends[-1]), np.uint64)
    esc = own_sel == 0
    out[begins[esc]] = words[at[esc] + 1]
    for s, c in COUNTS.items():
        own = own_sel == s
        if own.any():
            width = 60 // c
            shifts = (np.arange(c) * width).astype(np.uint64)
            vals = (words[at[own]][:, None] >> shifts) & np.uint64((1 << width) - 1)
            out[begins[own][:, None] + np.arange(c)] = vals
    return out[:n]


def file_bytes(doc_ids: list, sizes: list[int], blocks: list[np.ndarray], n_ids: int) -> bytes:
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype(np.uint64)
    null = np.array([x is None for x in doc_ids], np.uint64)
    ids = np.array([0 if x is None else x for x in doc_ids], np.int64).view(np.uint64)
    docs = np.stack([ids, np.array(sizes, np.uint64), null], axis=1).ravel() if doc_ids else np.zeros(0, np.uint64)
    head = np.array([MAGIC, len(doc_ids), n_ids, len(blocks), offsets[-1]], np.uint64)
    return b"".join(x.astype("<u8").tobytes() for x in [head, docs, offsets[:-1], *blocks])


def read_file(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, Iterator[np.ndarray]]:
    """(doc ids, is null, sizes, blocks of ids one after another)."""
    words = np.frombuffer(raw, "<u8")
    if len(words) < 5 or words[0] != MAGIC:
        raise ValueError("token file: wrong magic")
    n_docs, n_ids, n_blocks, n_words = map(int, words[1:5])
    docs = words[5:5 + 3 * n_docs].reshape(-1, 3)
    offsets = words[5 + 3 * n_docs:][:n_blocks].astype(np.int64)
    data = words[5 + 3 * n_docs + n_blocks:]
    if len(data) != n_words or int(docs[:, 1].sum()) != n_ids or n_blocks != -(-n_ids // BLOCK):
        raise ValueError("token file: lengths do not agree")

    def blocks() -> Iterator[np.ndarray]:
        for i, a in enumerate(offsets):
            b = offsets[i + 1] if i + 1 < n_blocks else n_words
            yield unpack_block(data[a:b], min(BLOCK, n_ids - i * BLOCK))

    return docs[:, 0].view(np.int64), docs[:, 2] == 1, docs[:, 1].astype(np.int64), blocks()


# -- tokenizing -----------------------------------------------------------
class ByteBpe:
    """Ids of the ``tokenizers`` library, asked once for each distinct word.

    A lone space between two characters that are not white space always begins
    a piece of the byte-level pattern, and a lone line break between two such
    characters is a piece of its own (the file's pattern is asked), so texts are cut
    there. Texts that hold an added token go to the library whole.

    Words travel as Arrow and numpy columns, and the ids of the words met so far lie in
    one flat array. Of words that are letters between an optional line break and an
    optional mark, only the letters are kept.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.split, self.merge = self.lib.pre_tokenizer.pre_tokenize_str, self.lib.model.tokenize
        alphabet = byte_alphabet()
        self.spelling = dict(enumerate(alphabet))  # how the vocabulary writes a byte
        # other patterns may take a line break together with what is before it
        self.breaks = all([p for p, _ in self.split(f"{x}\nb")][1:] == [self.spelling[10], "b"] for x in "a1.")
        self.lone = regex.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[%s][^\s\x1c-\x1f\x85])" % (" \n" if self.breaks else " "))
        vocab = self.lib.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(vocab.values(), default=-1) + 1, np.int64)  # bytes that an id stands for
        self.width[list(vocab.values())] = [len(token) for token in vocab]
        # the library's merges alone, for pieces that are spelled already and lie one to a line
        self.lines = Tokenizer(self.lib.model)
        self.lines.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.spelled_lines = np.array([10 if b == 10 else ord(c) for b, c in enumerate(alphabet)], "<u4")
        # words met so far by place; their ids one after another, numbers of these, in how many batches a word came
        self.place: dict[str, int] = dict(zip(FIXED, count()))
        own = [self.chunk_ids(c) for c in FIXED]
        self.flat, self.size = np.frombuffer(b"".join(own), "<u4"), np.array([len(x) // 4 for x in own])
        self.uses = np.ones(len(FIXED), np.int64)

    def known_all(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, little-endian."""
        ids, sizes = self.distinct_ids(pa.array(chunks, pa.large_string()))
        raw, stops = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]

    def distinct_ids(self, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks one after another, number of ids of each)."""
        lettered = plain(chunks, rf"\A[ \n]?\pL+[{MARKS}]?\z")
        keys = pc.if_else(lettered, pc.utf8_trim(chunks, "\n" + MARKS), chunks)
        if len(self.place) > 2 * CACHE_CHUNKS:
            self.forget()
        codes = np.fromiter(map(self.place.get, keys.to_numpy(zero_copy_only=False), repeat(-1)), np.int64, len(keys))
        unmet = np.flatnonzero(codes < 0)
        if len(unmet):
            new = keys.take(pa.array(unmet)).dictionary_encode()
            codes[unmet] = len(self.place) + new.indices.to_numpy()
            ids, sizes = self.ask(new.dictionary)
            self.place.update(zip(new.dictionary.to_numpy(zero_copy_only=False), count(len(self.place))))
            self.flat, self.size = np.concatenate([self.flat, ids]), np.concatenate([self.size, sizes])
            self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int64)])
        met = np.zeros(len(self.place), bool)
        met[codes] = True
        self.uses += met
        places = np.zeros((len(chunks), 3), np.int64)  # a line break, the word, a mark
        places[:, 1] = codes
        lettered = lettered.to_numpy(zero_copy_only=False)
        for part, end, at in [(0, pc.starts_with, 1), *((2, pc.ends_with, k) for k in range(2, len(FIXED)))]:
            places[lettered & end(chunks, FIXED[at]).to_numpy(zero_copy_only=False), part] = at
        ids, sizes = gathered(self.flat, self.size, places.ravel())
        return ids, sizes.reshape(-1, 3).sum(axis=1)

    def forget(self) -> None:
        """Keep the words that came in most batches, later batches counting more."""
        while np.count_nonzero(self.uses) > CACHE_CHUNKS:
            self.uses >>= 1
        self.uses[:len(FIXED)] += 1
        kept = np.flatnonzero(self.uses)
        self.place = dict(zip(compress(self.place, self.uses), count()))
        self.flat, self.size = gathered(self.flat, self.size, kept)
        self.uses = self.uses[kept]

    def ask(self, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """``distinct_ids`` from the library, which gets many chunks at a time.

        Letters, with a space before them or none, are one piece, so such chunks go as lines. Others that begin with
        a lone space or line break and end without white space keep their pieces when they follow one another. Where
        ids do not end with each chunk, every chunk is asked for alone.
        """
        lines = plain(chunks, r"\A ?\pL+\z").to_numpy(zero_copy_only=False)
        mixed = ~lines & matches(chunks, rf"(?s)\A[ \n]{NOT_WHITE}(.*{NOT_WHITE})?\z").to_numpy(zero_copy_only=False)
        order, got = [], []
        for group, coder, between in ((lines, self.lines, "\n"), (mixed, self.lib, "")):
            places = np.flatnonzero(group)
            for k in range(0, len(places), JOINED_CHUNKS):
                order.append(places[k:k + JOINED_CHUNKS])
                own = chunks.take(pa.array(order[-1]))
                text = between.join(own.to_numpy(zero_copy_only=False))
                if between:
                    text = self.spelled_lines[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
                    got.append(self.joined_ids(coder, text, own))
                else:
                    got.append(self.each_ids(own) if any(a in text for a in self.added) else self.joined_ids(coder, text, own))
        order.append(np.flatnonzero(~(lines | mixed)))
        got.append(self.each_ids(chunks.take(pa.array(order[-1]))))
        return gathered(np.concatenate([ids for ids, _ in got]), np.concatenate([sizes for _, sizes in got]),
                        np.argsort(np.concatenate(order)))

    def joined_ids(self, coder, text: str, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """``distinct_ids`` from ``coder``'s ids of one text that holds all chunks."""
        ids = np.array(coder.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        if len(ids) and ids.max() < len(self.width):
            reached, ends = np.cumsum(self.width[ids]), np.cumsum(pc.binary_length(chunks).to_numpy())
            at = np.searchsorted(reached, ends)
            if reached[-1] == ends[-1] and (reached[at] == ends).all():
                return ids, np.diff(at, prepend=-1)
        return self.each_ids(chunks)

    def each_ids(self, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        got = [self.chunk_ids(c) for c in chunks.to_pylist()]
        return np.frombuffer(b"".join(got), "<u4"), np.array([len(x) // 4 for x in got], np.int64)

    def encode_all(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each); a batch's distinct words are looked up once."""
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        whole = pa.array(np.zeros(len(column), bool))
        for a in self.added:
            whole = pc.or_(whole, pc.match_substring(column, a))
        spaced = pc.and_not(matches(column, rf"(\A|{WHITE}){WHITE}"), whole)
        odd = pc.or_(whole, spaced)
        ids, sizes = self.encode_plain(column.filter(pc.invert(odd)))
        if not pc.any(odd, min_count=0).as_py():
            return ids, sizes
        cut = [self.lone.split(t) for t in column.filter(spaced).to_pylist()]
        distinct = list(dict.fromkeys(chain.from_iterable(cut)))
        known = dict(zip(distinct, self.known_all(distinct)))
        apart = (np.frombuffer(b"".join(map(known.__getitem__, chunks)), "<u4") for chunks in cut)
        asked = (np.array(self.lib.encode(t, add_special_tokens=False).ids, np.uint32) for t in column.filter(whole).to_pylist())
        usual = iter(np.split(ids, np.cumsum(sizes)[:-1]))
        each = [next(asked) if w else next(apart) if o else next(usual) for w, o in zip(whole.to_pylist(), spaced.to_pylist())]
        return np.concatenate(each), np.array([len(x) for x in each])

    def encode_plain(self, column: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """``encode_all`` of texts without added tokens, white space at the start or two white spaces in a row."""
        if not len(column):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        # a line break stays with the word behind it; one is put before each text, whose first word has no space either
        lined = pc.replace_substring(column, "\n", " \n") if self.breaks else column
        parts = pc.split_pattern(pc.binary_join_element_wise(literal("\n"), lined, literal("")), " ")
        bounds = parts.offsets.to_numpy()
        words = parts.flatten().dictionary_encode()
        codes = words.indices.to_numpy()
        spaces = pc.if_else(pc.starts_with(words.dictionary, "\n"), literal(""), literal(" "))
        flat, size = self.distinct_ids(pc.binary_join_element_wise(spaces, words.dictionary, literal("")))
        skip = np.zeros(len(codes), np.int64)
        skip[bounds[:-1]] = self.size[1]  # the break that was put there
        ids, sizes = gathered(flat, size, codes, skip)
        return ids, np.diff(np.append(0, np.cumsum(sizes))[bounds])

    def chunk_ids(self, chunk: str) -> bytes:
        """The library's split and merges of one chunk, little-endian."""
        # letters, with a space before them or none, are one piece
        if chunk.removeprefix(" ").isalpha() and max(chunk) < "\u0500":
            pieces = [chunk.encode().decode("latin-1").translate(self.spelling)]
        else:
            pieces = [p for p, _ in self.split(chunk)]
        ids = array("I", [t.id for p in pieces for t in self.merge(p)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


def literal(x: str) -> pa.LargeStringScalar:
    return pa.scalar(x, pa.large_string())


def matches(column: pa.LargeStringArray, pattern: str) -> pa.BooleanArray:
    return pc.match_substring_regex(column, pattern)


def plain(column: pa.LargeStringArray, pattern: str) -> pa.BooleanArray:
    """Matches without other characters: letters below U+0500 are the same in all versions of Unicode in use."""
    return pc.and_not(matches(column, pattern), matches(column, r"[^\x00-\x{4FF}]"))


def gathered(flat: np.ndarray, size: np.ndarray, codes: np.ndarray, skip: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(runs ``codes`` of ``flat`` one after another, size of each) where runs of ``size`` lie end to end; the first ``skip`` of a run stay out."""
    begin, sizes = (np.cumsum(size) - size)[codes] + skip, size[codes] - skip
    out, done = np.zeros(sizes.sum(), flat.dtype), 0
    for k in range(0, len(codes), GATHERED):
        own = sizes[k:k + GATHERED]
        ends = np.cumsum(own)
        out[done:done + ends[-1]] = flat[np.repeat(begin[k:k + GATHERED] - (ends - own), own) + np.arange(ends[-1])]
        done += ends[-1]
    return out, sizes


# -- Spark ----------------------------------------------------------------
def write_token_files(docs: DataFrame, path: str, vocab_path: str, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` under ``path``; the result lists (file, n_docs, n_ids), and must be run once."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), empty_text(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast({})  # a Python worker keeps its copy, so its tasks share one coder
    ranged = src.repartitionByRange(partitions(docs), "doc_id", F.substring("text", 1, BOUND_CHARS)).sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        coder, doc_ids, sizes, blocks, rest = None, [], [], [], np.zeros(0, np.uint32 if end_id < 1 << 32 else np.uint64)
        for batch in text_slices(batches, BATCH_CHARS):
            if coder is None:
                coder = shared.value.get(vocab_path) or shared.value.setdefault(vocab_path, ByteBpe(vocab_path))
            ids, n = coder.encode_all(batch["text"])
            doc_ids += batch["doc_id"].to_pylist()
            sizes += (n + 1).tolist()
            ended = np.full(len(ids) + len(n), end_id, rest.dtype)
            inner = np.ones(len(ended), bool)
            inner[np.cumsum(n + 1) - 1] = False
            ended[inner] = ids
            flat = np.concatenate([rest, ended])
            cut = len(flat) // BLOCK * BLOCK
            blocks += [pack_block(flat[k:k + BLOCK].astype(np.uint64)) for k in range(0, cut, BLOCK)]
            rest = flat[cut:]
        if not doc_ids:
            return
        if len(rest):
            blocks.append(pack_block(rest.astype(np.uint64)))
        n_ids = sum(sizes)
        name = f"part-{task.partitionId():06d}.s8b"
        put_file(path, name, file_bytes(doc_ids, sizes, blocks, n_ids), task.taskAttemptId())
        yield pa.RecordBatch.from_pydict({"file": [name], "n_docs": [len(doc_ids)], "n_ids": [n_ids]})

    return ranged.mapInArrow(run, "file string, n_docs bigint, n_ids bigint")


def text_slices(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices whose texts have about ``limit`` bytes, at least one row each."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(), dtype=np.int64)
        start = base = 0
        while start < len(ends):
            stop = max(start + 1, int(ends.searchsorted(base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def put_file(folder: str, name: str, raw: bytes, attempt: int) -> None:
    """Write under a name of this attempt, then rename: readers never see half a file."""
    fs, root = open_folder(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/_{name}.{attempt}") as f:
        f.write(raw)
    fs.move(f"{root}/_{name}.{attempt}", f"{root}/{name}")


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    """The pyarrow file system and path of a folder given as a URI or a local path."""
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder[5:])
    return pafs.LocalFileSystem(), folder


def read_token_files(spark: SparkSession, path: str, manifest: list[tuple[str, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files of ``manifest`` = (file, n_ids) in order.

    The manifest is one row a file, as any file listing.
    """
    base, rows = 0, []
    for name, n_ids in manifest:
        rows.append((name, base))
        base += n_ids
    out = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if not rows:
        return spark.createDataFrame([], out)
    files = (spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "slot int, file string, base bigint")
             .repartitionById(len(rows), F.col("slot")))  # a task a file

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for name, base in zip(pdf["file"], pdf["base"]):
                fs, root = open_folder(path)
                with fs.open_input_file(f"{root}/{name}") as f:
                    doc_ids, null, sizes, blocks = read_file(f.read())
                yield pd.DataFrame({
                    "doc_id": pd.array(np.where(null, 0, doc_ids), "Int64").copy() if not null.any()
                    else pd.Series(doc_ids).astype("Int64").mask(null),
                    "start": int(base) + np.cumsum(sizes) - sizes, "n_tokens": sizes,
                    "ids_crc32": document_crcs(sizes, blocks)})

    return files.mapInPandas(run, out)


def document_crcs(sizes: np.ndarray, blocks: Iterator[np.ndarray]) -> list[int]:
    out, crc, d, left = [], 0, 0, int(sizes[0])
    for block in blocks:
        raw, at = block.astype("<u4").tobytes(), 0
        if (block >> np.uint64(32)).any():
            raise ValueError("an id does not fit 32 bits")
        while at < len(raw):
            take = min(4 * left, len(raw) - at)
            crc = zlib.crc32(raw[at:at + take], crc)
            at, left = at + take, left - take // 4
            if not left:
                out.append(crc)
                crc, d = 0, d + 1
                left = int(sizes[d]) if d < len(sizes) else 0
    return out


def token_file_digests(docs: DataFrame, vocab_path: str, end_id: int = 0) -> DataFrame:
    """Write token files in the shared work folder, then read them back."""
    spark = docs.sparkSession
    folder = work_dir(spark, "token-files")
    listed = write_token_files(docs, folder, vocab_path, end_id).collect()  # one row a file
    return read_token_files(spark, folder, sorted((r.file, r.n_ids) for r in listed))
