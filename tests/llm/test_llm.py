"""Operators of tickworks.llm against brute force, with nulls, empties, ties, repeats and clashing columns."""
import hashlib
import io
import math
import random
import tempfile
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tickworks.llm import (bpe, edit_embedding, lbl_model, line_templates, mixing, ngram_join, quality_cnn,
                           token_files, topk, warc)
from tickworks.llm.queries import tokenizer_file

WORDS = [a + b for a in ("ta", "ri", "mo", "sel", "vu", "ka") for b in ("n", "rd", "lo", "sti", "p", "me", "qua")]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, key string, score string, word string, copies int"


def prose(rng, n, end="."):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + end


def messy(rng):
    base = [prose(rng, 60) for _ in range(12)]
    near = base[0].split()
    near[30] = "changed"
    texts = [*base, base[0], " ".join(near), None, "", " \t\n", "one", "Two words", "Ünïcode Σας ﬁ 日本 <|endoftext|> x",
             prose(rng, 40_000), prose(rng, 20) + "\n" + base[3], "a  b \n c"]
    rows = [(i, t, "en", ("s1", "s0", None, "zz")[i % 4], 0, 1, "k", "s", "w", 7) for i, t in enumerate(texts)]
    rows += [rows[5], (None, base[1], "en", None, 0, 1, "k", "s", "w", 7), (None, None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return messy(random.Random(3))


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return sorted(df.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, str(r)))


def norm(t):
    return t or ""


# -- 1 -----------------------------------------------------------------------
def test_warc_round_trip(spark):
    pages = [(5, "u5", "same"), (2, "u 2\n", "same"), (9, None, "same"), (7, "u7", None), (8, "u8", ""), (3, "u3", "x" * 300_000),
             (None, "n", "same"), (4, "é", "héé\r\n\r\n"), (2, "u2", "same")]
    df = spark.createDataFrame([(*p, 1, "c") for p in pages], "page_id bigint, url string, html string, first int, sha1 string")
    got = warc.archived_pages(df).collect()
    assert len(got) == len(pages)
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[norm(h)] = min(i, first.get(norm(h), i))
    for i, _, h in pages:
        raw = norm(h).encode()
        r = [x for x in got if x.page_id == i and x.payload_digest == warc.sha1_base32(raw)][0]
        assert r.payload_bytes == len(raw)
        assert (r.record_type, r.refers_to) == (("response", None) if i == first.get(norm(h)) else ("revisit", first[norm(h)]))
    assert warc.archived_pages(df.limit(0)).count() == 0


def test_warc_attempts_never_share_a_name(spark, tmp_path, monkeypatch):
    """A second attempt that meets the rows in another order cuts them elsewhere and leaves the first one's archives alone."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    monkeypatch.setattr(warc, "DICT_SAMPLES", 4)
    rng = random.Random(21)
    pages = [(i, f"u{i}", prose(rng, 300)) for i in range(120)]
    listed = []
    for own in (pages, pages[::-1]):
        df = spark.createDataFrame(own, "page_id bigint, url string, html string").coalesce(1)
        listed.append(sorted(r.file for r in warc.write_archives(df, str(tmp_path)).collect()))
    assert all(len(files) > 1 for files in listed) and not set(listed[0]) & set(listed[1])
    for files in listed:
        got = warc.read_archives(spark, str(tmp_path), files)
        assert got.rdd.getNumPartitions() == len(files)
        assert sorted((r.page_id, r.payload_bytes) for r in got.collect()) == [(i, len(h)) for i, _, h in pages]


def test_warc_reader_rejects_damage():
    writer = warc.ArchiveWriter()
    raws = [warc.record(i, "u", b"body %d" % i * 50, warc.sha1_base32(b"body %d" % i * 50), None) for i in range(20)]
    for r in raws:
        writer.add(r)
    archive = writer.bytes()
    assert list(warc.read_archive(io.BytesIO(archive))) == raws
    for bad in (archive[:-3], b"x" + archive, archive[:40]):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(io.BytesIO(bad)))
    good = raws[0]
    for bad in (good.replace(b"WARC/1.1", b"WARK/1.1"), good[:-1], good.replace(b"body 0", b"body 1", 1),
                good.replace(b"WARC-Date", b"WARC-Dote"), good.replace(b"WARC-Type: ", b"WARC-Type ")):
        with pytest.raises(warc.WarcError):
            warc.parse_record(bad)
    raw_dict = warc.archive_start(b"") + zstandard.ZstdCompressor().compress(good)
    assert list(warc.read_archive(io.BytesIO(raw_dict))) == [good]


# -- 2 -----------------------------------------------------------------------
def plain_walk(walk, text):
    """Step by step, as the definition says."""
    out, i, t = [], 0, 0
    codes = walk.codes(text)
    while i < len(codes):
        out.append(i)
        c = int((codes[i:i + 1] * walk.class_mult)[0] >> np.uint32(26))
        moves = walk.nodes[t % edit_embedding.PERIOD][c][-1] == (t + 1) % edit_embedding.PERIOD
        i += moves
        t += 1
    return out


def test_edit_walk_matches_definition():
    walk = edit_embedding.EditWalk()
    text = prose(random.Random(1), 3_000)
    steps = walk.walk(walk.codes(text))
    under = plain_walk(walk, text)
    assert steps[-1] == len(under)
    assert (np.searchsorted(steps, np.arange(len(under)), side="right") - 1 == under).all()
    a = walk.fingerprint(walk.codes(text), steps)
    changed = text[:4_000] + "Q" + text[4_001:9_000] + "zz" + text[9_000:]
    b = walk.fingerprint(walk.codes(changed), walk.walk(walk.codes(changed)))
    other = prose(random.Random(2), 3_000)
    c = walk.fingerprint(walk.codes(other), walk.walk(walk.codes(other)))
    assert walk.likeness(a, b) > 0.9 > 0.2 > walk.likeness(a, c)
    start = walk.codes(text[:len(text) // 2])
    half = walk.fingerprint(start, walk.walk(start))
    assert 0.3 < walk.likeness(a, half) < 0.6


def test_edited_fingerprints(rows, docs, empty):
    got = by_id(edit_embedding.edited_fingerprints(docs))
    order = sorted(((r[0] if r[0] is not None else -math.inf, norm(r[1])) for r in rows))
    assert len(got) == len(order)
    want = Counter()
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        cut = len(t) // 4
        e = t[:len(t) - cut] + nxt[:cut]
        want[(None if i == -math.inf else i, len(t), hashlib.sha256(e.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert all(r.near_edited > 0.6 for r in got if r.n_chars > 200)
    prints = {}
    for r in edit_embedding.fingerprints(docs).collect():
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert all(r.fingerprint in prints[r.doc_id] for r in got)
    assert edit_embedding.edited_fingerprints(empty).count() == 0


def test_near_documents(docs):
    links = {(r.doc_id, r.near_id): r.likeness for r in edit_embedding.near_documents(docs).collect()}
    assert links[(13, 0)] >= 0.75 and all(v >= 0.75 for v in links.values())


def brute_near(items):
    """All pairs of documents whose fingerprints are alike."""
    walk = edit_embedding.EditWalk()
    prints = [walk.fingerprint(c, walk.walk(c)) for c in (walk.codes(norm(t)) for _, t in items)]
    return {(items[j][0], items[i][0]) for j in range(len(items)) for i in range(j) if walk.likeness(prints[i], prints[j]) >= 0.75}


def letters(rng, n):
    """Words that share nothing by chance."""
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n)]


def test_near_documents_edited_at_the_start_only(spark):
    rng, items = random.Random(21), []
    for k in range(60):
        words = letters(rng, rng.choice((540, 1_080, 1_100, 1_120)))
        cut = len(words) * rng.choice((20, 21, 22, 23)) // 100
        items += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*letters(rng, cut), *words[cut:]]))]
    want = brute_near(items)
    got = {(r.doc_id, r.near_id) for r in edit_embedding.near_documents(spark.createDataFrame(items, "doc_id bigint, text string")).collect()}
    assert len(want) > 5 and (len(got & want), len(got - want)) == (len(want), 0)


def brute_classes(items):
    """Smallest id of each document's component over all pairs."""
    walk = edit_embedding.EditWalk()
    prints = [walk.fingerprint(c, walk.walk(c)) for c in (walk.codes(norm(t)) for _, t in items)]
    label = list(range(len(items)))
    for i in range(len(items)):
        for j in range(i):
            if label[i] != label[j] and walk.likeness(prints[i], prints[j]) >= 0.75:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), x in zip(items, label):
        if d is not None:
            least[x] = min(d, least.get(x, d))
    return Counter((d, least.get(x)) for (d, _), x in zip(items, label))


def boilerplate_items(rng):
    """Unlike texts that share a long passage, and so bands, with near copies and exact copies among them."""
    passage, items = letters(rng, 70), []
    for k in range(60):
        text = passage + letters(rng, 11)
        items += [(7 * k % 61 + 100 * c, " ".join(text + letters(rng, 19))) for c in range(k % 4)]
    return [*items, (None, items[5][1]), (None, "alone"), (900, None), (901, ""), items[8]]


def test_near_members_in_shared_bands(spark, docs, rows, empty):
    items = boilerplate_items(random.Random(5))
    df = spark.createDataFrame(items, "doc_id bigint, text string").repartition(3)
    assert Counter(tuple(r) for r in edit_embedding.near_members(df).collect()) == brute_classes(items)
    assert edit_embedding.near_members(empty).count() == 0


def test_op2_carries_the_near_class(spark, docs, rows, empty):
    from tickworks.llm import queries
    path = tempfile.mkdtemp(prefix="tickworks-op2-")
    docs.select("doc_id", "text").write.parquet(f"{path}/documents.parquet")
    got = queries.op2_edit_fingerprints(spark, path)
    assert Counter((r.doc_id, r.near_class) for r in got.collect()) == brute_classes([r[:2] for r in rows])
    plain = edit_embedding.edited_fingerprints(docs)
    assert Counter(map(tuple, got.select(plain.columns).collect())) == Counter(map(tuple, plain.collect()))
    assert edit_embedding.classed_fingerprints(empty).count() == 0


def test_open_bands_travel_by_block(spark, monkeypatch):
    rng, sent = random.Random(17), []
    passage = letters(rng, 90)
    items = [(k, " ".join(passage + letters(rng, 46 - k % 3))) for k in range(160)]  # share bands, few are alike
    items += [(1_000 + k, items[9 * k][1][:-3] + "xyz") for k in range(12)]
    real = edit_embedding.cell_links
    monkeypatch.setattr(edit_embedding, "cell_links", lambda cells, t: sent.append(cells.count()) or real(cells, t))
    for n, block, part in ((80, 256, 8_192), (172, 256, 8_192), (172, 6, 8)):
        monkeypatch.setattr(edit_embedding, "BLOCK", block)
        monkeypatch.setattr(edit_embedding, "PART", part)
        sent.append(None)
        got = edit_embedding.near_members(spark.createDataFrame(items[-n:], "doc_id bigint, text string"))
        assert Counter(map(tuple, got.collect())) == brute_classes(items[-n:])
    small, large, cut = " ".join(map(str, sent)).split("None ")[1:]
    assert int(large.split()[0]) < 3 * int(small.split()[0])  # rows with the group's size, not with its square
    assert len(cut.split()) == 2


def test_cell_links_join_labels_once(spark):
    walk, rng = edit_embedding.EditWalk(), random.Random(23)
    text = " ".join(letters(rng, 200))
    items = [text[:k] + "#" + text[k:] for k in range(0, 1_200, 100)] + [" ".join(letters(rng, 200)) for _ in range(3)]
    prints = [walk.fingerprint(c, walk.walk(c)) for c in map(walk.codes, items)]
    level = max(p[0] for p in prints)
    want = [[walk.likeness(a, b) for b in prints] for a in prints]
    assert np.array_equal(edit_embedding.likenesses(walk, level, prints, prints), want)
    rows = [(level << 40, 0, 0, k < 5, k, k, bytes([p[0]]) + p[1]) for k, p in enumerate(prints)]
    cells = spark.createDataFrame(rows, "shingle bigint, block bigint, part bigint, head boolean, node bigint, label bigint, print binary")
    links = edit_embedding.cell_links(cells, 0.75).collect()
    assert len(links) == 11 and all(r.a < r.b < 12 and r.likeness == want[r.a][r.b] >= 0.75 for r in links)


def test_edited_texts_travel_packed_and_in_text_order(spark, monkeypatch):
    rng, seen = random.Random(29), []
    start = " ".join(letters(rng, 30))
    items = [(i, f"{start} {' '.join(letters(rng, 40))}") for i in (3, None, 3, 3, None, 8, None)]
    items += [items[0], (2, ""), (4, None), (3, start[:10]), (3, ""), (None, start)]
    real = edit_embedding.with_next
    monkeypatch.setattr(edit_embedding, "with_next", lambda src, *a: seen.append(src.columns) or real(src, *a))
    got = edit_embedding.edited_fingerprints(spark.createDataFrame(items, "doc_id bigint, text string").repartition(3)).collect()
    assert "text" not in seen[0] and "packed" in seen[0]
    ordered = sorted(((i, norm(t)) for i, t in items), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    want = []
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(text) // 4
        want.append((i, len(text), hashlib.sha256((text[:len(text) - cut] + after[:cut]).encode()).hexdigest()))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == Counter(want)


# -- 3 -----------------------------------------------------------------------
def test_mixing(rows, docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(norm(r[1]).split())
    order = sorted(s for s in sizes if s is not None) + [None]
    target, left, total = {}, list(order), 1.5 * sum(sizes.values())
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    while left:  # reshare until no source is above its ceiling
        level = total / sum(weight[s] for s in left)
        full = [s for s in left if weight[s] * level > 2 * sizes[s]]
        for s in full or left:
            target[s] = 2 * sizes[s] if full else weight[s] * level
            total -= target[s]
        left = [s for s in left if s not in target]
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= max(len(norm(r[1]).split()) for r in rows if r[3] == s)
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.text_hash, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))
    full = mixing.mixed_documents(docs)
    assert full.columns == docs.columns and full.count() == sum(r.copies for r in got)
    assert mixing.mix(empty).count() == 0


def test_pivot_keeps_words_and_expectation():
    size, p = np.array([5, 3, 8, 1, 1, 9, 2, 2.0]), np.full(8, 0.3)
    ups = np.zeros(8)
    for seed in range(4_000):
        q = mixing.pivot(size, p, np.random.default_rng(seed))
        assert ((q > 0) & (q < 1)).sum() <= 1 and abs((q * size).sum() - (p * size).sum()) < 1e-9
        ups += q
    assert np.abs(ups / 4_000 - 0.3).max() < 0.04


# -- 4 -----------------------------------------------------------------------
def test_bpe_equals_the_library(rows, docs, empty):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    encoded = bpe.encode(docs, tokenizer_file("word_bpe_49k.json"))
    want = Counter()
    for r in rows:
        ids = lib.encode(norm(r[1]), add_special_tokens=False).ids
        want[(r[0], tuple(ids), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in encoded.collect()) == want
    texts = bpe.decode(encoded, tokenizer_file("word_bpe_49k.json")).collect()
    assert Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in texts) == Counter(
        (i, d) for (i, _, d), n in want.items() for _ in range(n))
    assert bpe.encode(empty, tokenizer_file("word_bpe_49k.json")).count() == 0


def test_bpe_odd_texts():
    from tokenizers import Tokenizer
    lib, own = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json")), bpe.BpeCodec.load(tokenizer_file("word_bpe_49k.json"))
    rng = random.Random(5)
    texts = ["aaaaaaa" * 40, "x\x85y\x1cz", "'s'LL 12½", "İ ẞ ΟΔΟΣ", "👍🏽!!??", "é ́e", "<|startoftext|><|endoftext|"]
    texts += ["".join(rng.choice("aAbéΣ '’.\n\t1٣<|>日") for _ in range(30)) for _ in range(300)]
    assert own.encode_batch(texts) == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


# -- 5 -----------------------------------------------------------------------
def test_top_k(spark):
    rng = np.random.default_rng(4)
    vecs = [(i, [float(x) for x in rng.normal(0, 1, 4).round(1)]) for i in range(160)]
    vecs += [(200 + i, vecs[1][1]) for i in range(30)]  # ties
    vecs += [(300, None), (350, [1.0, None, 0.0, 0.0]), (400, [float("nan"), 0.0, 0.0, 0.0]), (450, [float("inf")] * 4),
             (None, [1.0] * 4), (500, [1.0, 2.0]), (7, vecs[7][1]), (550, [1e30] * 4), (551, [])]
    df = spark.createDataFrame([(*v, 1, "x") for v in vecs], "vec_id bigint, embedding array<double>, id int, slot string")
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in vecs
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    got = topk.top_k(df).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == best_of(ok)
    assert topk.top_k(df.limit(0)).count() == 0


def best_of(ok):
    """Best five of each query among integer vectors; only sums that no long holds are cut."""
    want, most = set(), 2 ** 63 - 2 ** 12
    for q, v in ok:
        if q % 50 == 0:
            scored = sorted((-max(-most, min(most, sum(a * b for a, b in zip(v, w)))), c)
                            for c, w in ok if c != q and len(w) == len(v))[:5]
            want |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(scored)}
    return want


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5])
def test_top_k_of_few_candidates(spark, n):
    vecs = [(50, [0.6, 0.8]), *[(i + 1, [0.8, 0.1 * i]) for i in range(n)], (100, [1.0, 0.0, 0.0])]
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in vecs]
    got = topk.top_k(spark.createDataFrame(vecs, "vec_id bigint, embedding array<double>")).collect()
    assert len(got) == len(set(got)) == n and {tuple(r) for r in got} == best_of(ok)


@pytest.mark.parametrize("largest", [4.2e6, 7e6, 1.1e7])
def test_top_k_of_large_scores(spark, largest):
    """Sums between 2^60 and 2^63 stay exact, negative ones too."""
    vecs = [(i, [(-1) ** (i // 40) * largest + i, largest / 3 - i]) for i in range(60)]
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in vecs]
    top = max(abs(sum(a * b for a, b in zip(v, w))) for _, v in ok for _, w in ok)
    assert 2 ** 60 < top < 2 ** 63 - 2 ** 12
    got = topk.top_k(spark.createDataFrame(vecs, "vec_id bigint, embedding array<double>")).collect()
    assert {tuple(r) for r in got} == best_of(ok)


def test_top_k_beyond_a_long(spark):
    """Components that are not finite once scaled take no part; sums that no long holds tie at the bound."""
    vecs = [(0, [1e307, 0.0]), (50, [1e200, 1.0]), (1, [1e200, 2.0]), (2, [-1e200, 0.0]), (3, [0.0, 1.0]), (4, [1e150, 0.0])]
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in vecs[1:]]
    got = topk.top_k(spark.createDataFrame(vecs, "vec_id bigint, embedding array<double>")).collect()
    assert {tuple(r) for r in got} == best_of(ok)


# -- 6 -----------------------------------------------------------------------
def test_line_templates(spark, docs, empty):
    rng = random.Random(8)
    unique = [prose(rng, 30) for _ in range(4)]
    long = prose(rng, 60)
    varied = long.split()
    varied[40] = "other"
    texts = {1: f"{unique[0]}\n{long}\nok", 2: f"{long}\n{unique[1]}\nok", 3: f"{unique[2]}\n{' '.join(varied)}",
             4: f"server 12 has lost its disk\n{unique[3]}", 5: "server 977 has lost its disk", 6: None, 7: ""}
    df = spark.createDataFrame([*texts.items(), (2, texts[2])], "doc_id bigint, text string").withColumn("h", F.lit(1))
    got = line_templates.document_lines(df).collect()
    want = dict(texts) | {2: f"{unique[1]}\nok", 3: unique[2], 5: ""}
    assert Counter((r.doc_id, r.text) for r in got) == Counter([*want.items(), (2, want[2])])
    everywhere = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(df, keep_first=False).collect()}
    assert everywhere == want | {1: f"{unique[0]}\nok", 4: unique[3]}  # the repeated row 2 is no second document
    full = line_templates.drop_recurring_lines(docs)
    assert full.count() == docs.count() and full.columns[:len(docs.columns)] == docs.columns
    assert line_templates.document_lines(empty).count() == 0


def test_line_templates_scattered_fields_and_short_lines(spark):
    """Any two fields of a long line may vary; short lines go only when chance does not explain them."""
    rng = random.Random(18)
    bases = [(prose(rng, 24).split(), *rng.sample(range(2, 24), 2)) for _ in range(5)]
    texts = {}
    for i in range(40):
        base, a, b = bases[i % 5]
        line = list(base)
        line[a], line[b] = f"name{chr(97 + i % 26)}x", "p" * (i + 1)
        own = prose(rng, 30)
        # 'Only one.' stands in two documents; 'ta ri' style pairs are what chance gives of these words
        short = [rng.choice(WORDS[:4]) + " " + rng.choice(WORDS[:4]) for _ in range(3)]
        notice = ["All rights reserved."] if i % 4 == 0 else []
        texts[i] = "\n".join([" ".join(line), own, *short, *notice, *(["Only one."] if i < 2 else []), "12 34"])
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r.text.split("\n") for r in line_templates.document_lines(df).collect()}
    for i, text in texts.items():
        gone = {0} if i >= 5 else set()
        want = [x for n, x in enumerate(text.split("\n")) if n not in gone and (x != "All rights reserved." or i == 0)]
        assert got[i] == want
    plan = line_templates.document_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


# -- 7 -----------------------------------------------------------------------
def test_lbl_scores(spark, rows, docs, empty):
    got = lbl_model.scores(docs).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 10 == 0
    c, n_docs = Counter(), 0
    for r in rows:
        if not held(r[0]):
            c.update(norm(r[1]).encode().lower().split())
            n_docs += 1
    n, v = sum(c.values()) + n_docs, len(c) + 1
    want = Counter()
    for r in rows:
        ws = norm(r[1]).encode().lower().split()
        base = sum(math.log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in [*[c[w] for w in ws], n_docs])
        want[(r[0], held(r[0]), len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n, round(base, 3))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lbl_model.scores(empty).count() == 0


def test_lbl_learns_context_and_is_normalised():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 10, 40_000), rng.integers(0, 2, 4_000)
    docs = [a[i * 10:i * 10 + 10] + 10 * b[i] for i in range(4_000)]  # two disjoint vocabularies
    noise = np.bincount(np.concatenate(docs), minlength=22) + 1.0
    noise[20] = 4_000
    model = lbl_model.Lbl(20, noise / noise.sum())
    ctx, w, _ = model.sequence(docs)
    before = model.log_probs(ctx, w).mean()
    state = {}
    for k in range(6):
        model.train(ctx, w, state, np.random.default_rng(k))
    assert model.log_probs(ctx, w).mean() > before + 0.3
    total = sum(np.exp(model.log_probs(ctx[:50], np.full(50, k))) for k in range(22))
    assert np.abs(total - 1).max() < 1e-4
    scorer = lbl_model.Scorer(model)
    for part in (slice(0, 300), slice(100, 900)):  # norms are kept between calls
        for c, t, got in zip(ctx[part], w[part], scorer.log_probs(ctx[part], w[part])):
            h = sum(model.r[c[i]].astype(float) * model.c[i] for i in range(lbl_model.CONTEXT))
            logits = model.q.astype(float) @ h + model.b
            assert abs(logits[t] - math.log(np.exp(logits).sum()) - got) < 1e-4


def test_lbl_score_is_the_sum_over_tokens(spark):
    """``score`` of a text against the plain sum of its tokens' log-probabilities under the same model."""
    rng = random.Random(5)
    items = [(i, prose(rng, 40) + (" rare%d" % i) * (i % 3)) for i in range(60)]
    made = []

    class Kept(lbl_model.Lbl):
        def __init__(self, *args, **kwargs):
            super().__init__(*args, **kwargs)
            made.append(self)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(lbl_model, "Lbl", Kept)
        m.setattr(lbl_model, "CLASSES", 20)
        m.setattr(lbl_model, "train_round", lambda texts, classes, model, every: model.flat() * np.float32(0.9))
        got = {r.doc_id: r.score for r in lbl_model.scores(spark.createDataFrame(items, "doc_id bigint, text string")).collect()}
    model = made[0]
    counts = Counter(x for i, t in items if zlib.crc32(str(i).encode()) % 10 for x in t.encode().lower().split())
    words = sorted(counts, key=lambda x: (-counts[x], x))
    index, rest_n = {x: i for i, x in enumerate(words[:20])}, sum(counts[x] for x in words[20:])
    for i, t in items:
        before, want = [model.start] * lbl_model.CONTEXT, 0.0
        for x in [*t.encode().lower().split(), None]:
            k = model.end if x is None else index.get(x, model.rest)
            logits = model.q.astype(float) @ sum(model.r[before[-1 - j]].astype(float) * model.c[j] for j in range(lbl_model.CONTEXT)) + model.b
            want += (logits[k] - math.log(np.exp(logits).sum())) / math.log(10)
            if k == model.rest:
                want += math.log10((counts[x] + 0.1) / (rest_n + 0.1 * (len(words) - 20 + 1)))
            before.append(k)
        assert abs(got[i] - want) < 1e-3


def test_frequent(spark):
    from tickworks.llm.common import frequent
    counts = [1] * 50 + [2] * 20 + [3] * 5 + [5_000, 5_001, 90_000]
    df = spark.createDataFrame(list(enumerate(counts)), "key bigint, n bigint")
    for most, want, edge in ((100, len(counts), 0), (30, 28, 50), (28, 28, 50), (10, 8, 20), (2, 1, 2), (0, 0, 1)):
        head, rest = frequent(df, "n", most)
        assert sorted(r.n for r in head.collect()) == sorted(counts)[len(counts) - want:]
        assert rest.count() == edge
    head, rest = frequent(df.limit(0), "n", 5)
    assert head.count() == rest.count() == 0


# -- 8 -----------------------------------------------------------------------
def test_quality_cnn(spark, docs, empty):
    rng = random.Random(6)
    texts = [(i, prose(rng, 80) if i % 2 else prose(rng, 80).replace(" ", "!! ")) for i in range(300)] + [(900, None), (901, "")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(5, 0, 0), (None, 1, 1), (6, None, 0), (7, 9, 0)],
                                   "doc_id bigint, quality int, toxic int")
    got = quality_cnn.scores(df, labels).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    tested = [r for r in got if r.held_out and r.doc_id < 300]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == r.doc_id % 2 for r in tested]) > 0.9
    assert len({r.score for r in got if r.doc_id >= 900}) == 1
    kept = quality_cnn.accepted(docs, labels)
    assert kept.columns == docs.columns and quality_cnn.scores(docs, labels.limit(0)).where("score <> 0.5").count() == 0
    assert quality_cnn.scores(empty, labels).count() == 0


def test_cnn_chunks_cover_and_gradients():
    raw = bytes(range(256)) * 9
    own = quality_cnn.chunks(raw)
    step = quality_cnn.CHUNK - quality_cnn.OVERLAP
    assert b"".join(c[:step].astype(np.uint8).tobytes() for c in own)[:len(raw)].startswith(raw[:step * (len(own) - 1)])
    assert (own[-1] == quality_cnn.PAD).sum() == (len(own) - 1) * step + quality_cnn.CHUNK - len(raw)
    model = quality_cnn.ByteCnn()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    texts, y = [own, quality_cnn.chunks(b"short")], np.array([1.0, 0.0])
    loss = lambda: -sum(np.log(s if t else 1 - s) for s, t in zip(model.score([raw, b"short"]), y)) / 2
    grads = model.gradients(texts, y)
    for name, at in (("filter", (3, 4)), ("bias", 5), ("out", 6), ("embed", (65, 2)), ("shift", 0)):
        old, eps = model.p[name][at], 1e-5
        model.p[name][at] = old + eps
        up = loss()
        model.p[name][at] = old - eps
        assert abs((up - loss()) / (2 * eps) - grads[name][at]) < 1e-4
        model.p[name][at] = old


# -- 9 -----------------------------------------------------------------------
def shingles(text):
    ws = norm(text).encode().lower().split()
    return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute_components(items):
    sets = [shingles(t) for _, t in items]
    up = list(range(len(items)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return Counter((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(items, sets)))


def test_ngram_join(spark, rows, docs, empty):
    got = ngram_join.joined(docs).collect()
    assert Counter(tuple(r) for r in got) == brute_components([r[:2] for r in rows])
    assert ngram_join.joined(empty).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[12] == ids[13] == 0 and ids[0] == ids[5] == 1


def test_one_of_each_goes_by_row(spark):
    """Repeated and null ids: one row of a component stays, other texts of its id are left alone."""
    rng = random.Random(12)
    a, b, c, d = (prose(rng, 40) for _ in range(4))
    near = a.split()
    near[39] = "other"
    rows = [(3, a), (1, " ".join(near)), (3, b), (3, b), (None, c), (None, c), (None, a), (9, d), (None, d),
            (4, ""), (4, ""), (4, None), (5, ""), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as row", "2 as id").repartition(3)
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    want = [(1, " ".join(near)), (3, b), (None, c), (9, d), (4, ""), (4, None), (5, ""), (None, None), (None, "")]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)


def test_ngram_join_chains_and_shared_passages(spark):
    rng = random.Random(11)
    items, base, passage = [], prose(rng, 80).split(), prose(rng, 55)
    for i in range(40):  # a chain: neighbours are near, ends are not
        items.append((i * 3 % 41, " ".join(base)))
        base = list(base)
        base[rng.randrange(80)] = f"w{i}"
    items += [(100 + i, prose(rng, 30) + " " + passage + " " + prose(rng, 30)) for i in range(30)]
    items += [(200 + i, passage + " " + prose(rng, 8)) for i in range(30)]
    df = spark.createDataFrame(items, "doc_id bigint, text string")
    assert Counter(tuple(r) for r in ngram_join.joined(df).collect()) == brute_components(items)


def test_ngram_join_tells_words_apart_that_agree_modulo_powers_of_two(spark):
    """Thue-Morse words agree in any polynomial hash modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(2_048)]
    items = []
    for n in (1_024, 2_048):
        for k, letters in enumerate(("ab", "ba")):
            word = "".join(letters[b] for b in bits[:n])
            items += [(n + k, f"{word} c d e"), (n + 10 + k, " ".join(["x", word] * 30))]
    df = spark.createDataFrame(items, "doc_id bigint, text string")
    got = Counter(tuple(r) for r in ngram_join.joined(df).collect())
    assert got == brute_components(items) and all(c == i for i, _, c in got)


# -- 10 ----------------------------------------------------------------------
def test_token_files(rows, docs, empty):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    got = [tuple(r) for r in token_files.token_file_digests(docs, tokenizer_file("byte_bpe_50k.json")).collect()]
    start, want = 0, []
    for i, t in sorted(((r[0] if r[0] is not None else -math.inf, norm(r[1])) for r in rows)):
        ids = [*lib.encode(t, add_special_tokens=False).ids, 0]
        want.append((None if i == -math.inf else i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert Counter(got) == Counter(want)
    assert token_files.token_file_digests(empty, tokenizer_file("byte_bpe_50k.json")).count() == 0


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for k in range(300):
        n = int(rng.integers(1, 500))
        x = rng.integers(0, 1 << 62, n).astype(np.uint64) * np.uint64(4) + np.uint64(3)
        x >>= rng.integers(0, 64, n).astype(np.uint64) if k % 2 else np.uint64(k % 64)
        if k % 3 == 0:
            x[:n // 2] = 0
        words = token_files.pack_block(x)
        assert (token_files.unpack_block(words, n) == x).all()
        with pytest.raises(ValueError):
            token_files.unpack_block(words[:-1], n)
    raw = token_files.file_bytes([1, None], [2, 1], [token_files.pack_block(np.array([5, 6, 7], np.uint64))], 3)
    with pytest.raises(ValueError):
        token_files.read_file(raw[:-8])


def test_batched_byte_bpe_equals_the_library():
    rng = random.Random(3)
    letters = "ab .,\n\t '1é　\x1c\x85s"
    texts = ["", " ", "a ", " a", "a  b", "a <|endoftext|> b", "can't  won't", "été. ñ,", "a​ b", "\x00 a"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 20))) for _ in range(1000)]
    coder = token_files.ByteBpe(tokenizer_file("byte_bpe_50k.json"))
    ids, n = coder.encode_all(texts)
    for t, got in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
        assert got.tolist() == coder.lib.encode(t, add_special_tokens=False).ids


def test_new_chunks_go_to_the_library_together(monkeypatch):
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["", "(", "x1"]) + w + rng.choice(["", ",", ".", "!?", "é"]) for w in letters(rng, 60)) for _ in range(40)]
    texts += ["Σας ﬁ 日本 don't", "\u0500a \u04ffb", "a b. b c. c.", "q \nw e\n r"]
    coder = token_files.ByteBpe(tokenizer_file("byte_bpe_50k.json"))
    alone, real = [], coder.chunk_ids
    monkeypatch.setattr(coder, "chunk_ids", lambda chunk: alone.append(chunk) or real(chunk))
    ids, n = coder.encode_all(texts)
    for t, got in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
        assert got.tolist() == coder.lib.encode(t, add_special_tokens=False).ids
    assert len(alone) < 60 < len({c for t in texts for c in t.split()}) / 10  # first words, marks and odd ones
    monkeypatch.setattr(coder, "width", np.ones_like(coder.width))  # lengths that do not agree: each chunk alone
    assert coder.known_all([" zyxw", " vut."]) == [real(" zyxw"), real(" vut.")]


def test_words_behind_line_breaks_are_asked_for_once(monkeypatch):
    rng = random.Random(12)
    pool = letters(rng, 200) + ["Été", "\u0394x", "\u0500b", "don't", "x1,", "日本"]
    texts = ["".join(rng.choice([" ", "\n", ". ", ".\n", ",\n"]) + rng.choice(pool) for _ in range(30))[rng.randint(0, 1):]
             for _ in range(300)]
    texts += ["", "\n", "\t", "\x1c", "\u3000", " ", "\na", "\ta", "a\n", "a\t", "\n a", "\n\n", "\n\na b", "a\n\nb.\n c", ".\n.", "\n.", "a\r\nb c\r\n", "a\tb,\nc\t d", "a!?\n(b\nc-d.\n"]
    coder, asked = token_files.ByteBpe(tokenizer_file("byte_bpe_50k.json")), []
    real = coder.joined_ids
    monkeypatch.setattr(coder, "joined_ids", lambda c, text, chunks: asked.extend(map(str, chunks)) or real(c, text, chunks))
    for most in (token_files.CACHE_CHUNKS, 50):  # then words are forgotten between batches
        monkeypatch.setattr(token_files, "CACHE_CHUNKS", most)
        for k in range(0, len(texts), 40):
            ids, n = coder.encode_all(texts[k:k + 40])
            for t, got in zip(texts[k:k + 40], np.split(ids, np.cumsum(n)[:-1]), strict=True):
                assert got.tolist() == coder.lib.encode(t, add_special_tokens=False).ids
        if most > 50:  # a word has one entry, whatever break and mark stand beside it
            words = [c for c in asked if c.strip().isalpha() and max(c) < "\u0500"]
            assert len(words) == len(set(words)) <= 2 * len(pool) and not any("\n" in c for c in words)
            assert len(asked) < len({c for t in texts for c in t.split(" ")}) / 2


def test_line_breaks_that_are_no_piece_of_their_own(tmp_path):
    from tokenizers import Regex, Tokenizer, pre_tokenizers
    lib = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    pattern = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    lib.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"),
                                                 pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    lib.save(str(tmp_path / "other.json"))
    coder = token_files.ByteBpe(str(tmp_path / "other.json"))
    assert not coder.breaks and token_files.ByteBpe(tokenizer_file("byte_bpe_50k.json")).breaks
    rng = random.Random(13)
    texts = ["".join(rng.choice([" ", "\n", ". ", ".\n", ")\n", "\n\n"]) + w for w in letters(rng, 20)) for _ in range(100)]
    texts += ["", "\n", "a\n", "a.\n", "\na", "a.\n\n b"]
    ids, n = coder.encode_all(texts)
    for t, got in zip(texts, np.split(ids, np.cumsum(n)[:-1]), strict=True):
        assert got.tolist() == lib.encode(t, add_special_tokens=False).ids


def test_words_take_the_most_ids_that_fit():
    rng = np.random.default_rng(5)
    counts = [(1, token_files.ZEROS), *token_files.COUNTS.items()]
    for widths in ([16], [1, 16], [0], [0, 0, 0, 60, 61, 64], list(range(65))):
        for n in (1, 59, 119, 120, 121, 700):
            ids = np.array([int(rng.integers(0, 1 << 62)) << 2 >> 64 - int(w) if w else 0 for w in np.repeat(rng.choice(widths, n), rng.choice([1, 1, 150], n))[:n]], np.uint64)
            words, i, heads = token_files.pack_block(ids), 0, []
            while i < n:
                sel = next((s for s, c in counts if (s > 1 or i + c <= n) and int(ids[i:i + c].max()) <= (0 if s == 1 else (1 << 60 // c) - 1)), 0)
                heads += [sel] + [None] * (sel == 0)
                i += dict(counts).get(sel, 1)
            assert len(heads) == len(words) and all(h is None or int(w) >> 60 == h for h, w in zip(heads, words))
            assert (token_files.unpack_block(words, n) == ids).all()
