"""BPE encoding and decoding in batched numpy merge rounds.

``BpeCodec`` reads a ``tokenizers`` JSON file with end-of-word BPE (lower case,
white space dropped) and reproduces the library's ids:

1. added tokens are cut out of the raw text;
2. the rest is cut at ASCII white space into chunks (no piece ever spans white
   space, and NFC never composes across it); equal chunks are encoded once;
3. the new chunks of a batch are normalised and split into pieces by the file's
   pattern, and the symbols of all pieces lie in ONE flat array. Each round
   finds every adjacent pair's rank by binary search over the sorted pair keys,
   takes each piece's lowest rank, merges all its occurrences from the left,
   and drops the pieces that have no pair left; later rounds look up only the
   pairs that a merge has changed.

Nulls: a null text is the empty text (no ids, empty decoded text). Repeated rows
give repeated results; a null ``doc_id`` is carried through. Other columns of
the input are ignored, whatever their names. An empty table gives an empty
result. Texts are never cut; texts are taken about ``BATCH_CHARS`` characters at a
time, so memory is that share (or one longer text) plus the chunk cache
(``CACHE_CHUNKS`` entries, then it starts afresh; the ids don't depend on it).
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import empty_text, rebatch

CACHE_CHUNKS = 400_000
BATCH_CHARS, BATCH_IDS = 1_000_000, 500_000
NO_RANK = np.iinfo(np.int64).max


def byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class BpeCodec:
    def __init__(self, spec: dict):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.added_re = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        suffix = model.get("end_of_word_suffix") or ""
        pre = spec["pre_tokenizer"]["pretokenizers"][0]
        self.piece_re = regex.compile(pre["pattern"]["Regex"])
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.last = np.array([vocab[c + suffix] for c in alphabet], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.width = max(self.tokens) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.cache: dict[bytes, list[int]] = {}

    @classmethod
    def load(cls, path: str) -> BpeCodec:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def pair_ranks(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each place; NO_RANK without a merge."""
        nxt = np.minimum(at + 1, len(sym) - 1)
        key = sym[at] * self.width + sym[nxt]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (nxt > at) & (word[at] == word[nxt]) & (self.keys[found] == key)
        return np.where(ok, self.ranks[found], NO_RANK)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of non-empty pieces (UTF-8), all merged together."""
        if not pieces:
            return []
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        sym = self.inner[raw]
        ends = np.cumsum(n)
        sym[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(pieces)), n)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = self.pair_ranks(sym, word, np.arange(len(sym)))
        while len(sym):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, first)
            per_sym = np.repeat(best, np.diff(np.append(first, len(sym))))
            idle = per_sym == NO_RANK
            if idle.any():
                done.append((word[idle], sym[idle]))
                live = ~idle
                sym, word, rank, per_sym = sym[live], word[live], rank[live], per_sym[live]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == per_sym)
            # in a run of overlapping matches (a a a) every second one merges
            begins = np.append(True, np.diff(at) > 1)
            run = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            sym[at] = self.made[per_sym[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, word, rank = sym[keep], word[keep], rank[keep]
            at -= np.arange(len(at))  # places after the merge
            touched = np.concatenate([at, at[at > 0] - 1])
            rank[touched] = self.pair_ranks(sym, word, touched)
        if not done:
            return [[] for _ in pieces]
        words = np.concatenate([w for w, _ in done])
        syms = np.concatenate([s for _, s in done])
        order = np.argsort(words, kind="stable")
        flat = syms[order].tolist()
        stops = np.cumsum(np.bincount(words, minlength=len(pieces))).tolist()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def pieces(self, chunk: bytes) -> list[bytes]:
        if chunk.isalpha():  # ASCII letters only: one piece
            return [chunk.lower()]
        text = unicodedata.normalize("NFC", chunk.decode())
        # lower case by single characters: no context rule for the final sigma
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        return [p.encode() for p in self.piece_re.findall(text)]

    def fill(self, chunks: set[bytes]) -> None:
        """Encode the chunks that the cache lacks."""
        if len(self.cache) + len(chunks) > CACHE_CHUNKS:
            self.cache = {}
        new = [c for c in chunks if c not in self.cache]
        cut = [self.pieces(c) for c in new]
        uniq = list(dict.fromkeys(chain.from_iterable(cut)))
        ids = dict(zip(uniq, self.encode_pieces(uniq)))
        for c, ps in zip(new, cut):
            self.cache[c] = ids[ps[0]] if len(ps) == 1 else list(chain.from_iterable(map(ids.__getitem__, ps)))

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        cut: list[list] = []
        for text in texts:
            if self.added_re and "<|" in text and self.added_re.search(text):
                parts: list = []
                for x in self.added_re.split(text):
                    parts += [self.added[x]] if x in self.added else x.encode().split()
                cut.append(parts)
            else:
                cut.append(text.encode().split())
        out: list[list[int]] = []
        start = 0
        while start < len(cut):  # whole texts, until their chunks fill a share of the cache
            want: set = set()
            stop = start
            while stop < len(cut) and (stop == start or len(want) < CACHE_CHUNKS // 4):
                want.update(cut[stop])
                stop += 1
            own = {x for x in want if isinstance(x, int)}
            self.fill(want - own)
            get = self.cache.__getitem__
            for parts in cut[start:stop]:
                if own and any(isinstance(x, int) for x in parts):
                    out.append(list(chain.from_iterable([x] if isinstance(x, int) else get(x) for x in parts)))
                else:
                    out.append(list(chain.from_iterable(map(get, parts))))
            start = stop
        return out

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: token strings joined by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids))


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """(doc_id, ids array<int>, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    ``with_ids=False`` leaves the id arrays out of the result.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), empty_text(text_col).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = BpeCodec.load(vocab_path)
        for pdf in rebatch(frames, "text", BATCH_CHARS):
            ids = codec.encode_batch(pdf["text"].tolist())
            out = {"doc_id": pdf["doc_id"]}
            if with_ids:
                out["ids"] = [np.array(x, np.int32) for x in ids]
            out["n_tokens"] = [len(x) for x in ids]
            out["ids_sha256"] = [hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in ids]
            out["decoded_sha256"] = [hashlib.sha256(codec.decode(x).encode()).hexdigest() for x in ids]
            yield pd.DataFrame(out)

    id_type = dict(src.dtypes)["doc_id"]
    return src.mapInPandas(
        run, f"doc_id {id_type}, {'ids array<int>, ' if with_ids else ''}n_tokens bigint, "
             "ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from id arrays; null ids give a null text."""
    src = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = BpeCodec.load(vocab_path)
        for pdf in rebatch(frames, "ids", BATCH_IDS):
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "text": [None if x is None else codec.decode(list(x)) for x in pdf["ids"]]})

    return src.mapInPandas(run, f"doc_id {dict(src.dtypes)['doc_id']}, text string")
