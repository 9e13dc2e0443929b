"""Spelling variants, Merkle manifest and uniform shards against plain Python, and their edge cases."""
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tickworks.llm import merkle, shards, spelling

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, key int, word string, slot string, shard int"


def docs_of(spark, rows):
    """rows: (doc_id, source, text); the other columns clash with names used inside."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), 1, "w", "s", 7) for i, s, t in rows], DOC)


# -- spelling variants ----------------------------------------------------------
def plain_words(rows):
    n = Counter()
    for i, _, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                run = run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run
                n[run] += len(run) >= 7
            run = ""
    return {w: k for w, k in n.items() if k >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(rows):
    n = plain_words(rows)
    out, form = {}, {}
    for w in n:
        near = [v for v in n if v != w and abs(len(v) - len(w)) < 2 and one_apart(v, w)]
        best = min(near, key=lambda v: (-n[v], v)) if near else None
        form[w] = best if best and n[best] >= 10 * n[w] else None
        out[w] = len(near)
    rows = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n[w], out[w], n[form[w]] if form[w] else None))
    return rows


def variant_rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def word_texts():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdeiortzé×É") for _ in range(rnd.randint(7, 10))) for _ in range(25)]
    def edited(w):
        k, c = rnd.randrange(len(w)), rnd.choice("abeoré")
        return rnd.choice([w[:k] + c + w[k + 1:], w[:k] + w[k + 1:], w[:k] + c + w[k:], w.upper()])
    words = base + [edited(w) for w in base for _ in range(6)]
    words += [edited(w) for w in words[:80]]
    counts = [rnd.choice([1, 2, 2, 3, 25, 300]) for _ in words]
    pool = [w for w, c in zip(words, counts) for _ in range(c)]
    rnd.shuffle(pool)
    return [(i if i % 9 else None, "a", rnd.choice([" ", ", ", "1", "\n"]).join(pool[i * 40:i * 40 + 40])) for i in range(len(pool) // 40 + 1)]


def test_spelling_variants_equal_brute_force(spark):
    rows = [*word_texts(), (1000, "a", None), (1001, "a", ""), (1002, "a", "abcdefg" * 3), (1002, "a", "abcdefg" * 3)]
    want = plain_variants(rows)
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] not in (r[0], r[1]) for r in want)
    docs = docs_of(spark, rows)
    assert variant_rows(spelling.spelling_variants(docs)) == want
    assert variant_rows(spelling.spelling_variants(docs.repartition(5), tile=2)) == want   # many tiles a block


def test_spelling_long_runs_and_empty(spark):
    long = "".join(random.Random(2).choice("abcdefgh") for _ in range(30_000))
    rows = [(i, "a", t) for i, t in enumerate([long, long[:9] + "z" + long[10:], long[:70] + long[71:], "anagrams margaans"] * 2)]
    got = {r[0]: r for r in variant_rows(spelling.spelling_variants(docs_of(spark, rows)))}
    words = plain_words(rows)
    assert set(got) == set(words)
    assert got[long][4] == 2 if long in words else True
    assert got.get("anagrams", (0,) * 5)[4] == 0
    empty = docs_of(spark, rows).limit(0)
    assert variant_rows(spelling.spelling_variants(empty)) == set()
    assert variant_rows(spelling.spelling_variants(docs_of(spark, [(1, None, None), (None, None, "")]))) == set()


# -- Merkle manifest ------------------------------------------------------------
def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(i, source, text, *tampered):
    fields = [i, source, "en", None if text is None else len(text), *(tampered or [text])]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def plain_manifest(rows):
    def proofs(nodes):
        """(root, siblings (left, right) by level of each node)"""
        own, paths, at = list(nodes), [[] for _ in nodes], list(range(len(nodes)))
        while len(own) > 1:
            runs = [own[k:k + 16] for k in range(0, len(own), 16)]
            for k, path in enumerate(paths):
                run, p = runs[at[k] // 16], at[k] % 16
                path.append(("".join(run[:p]), "".join(run[p + 1:])))
                at[k] //= 16
            own = [sha(*r) for r in runs]
        return own[0], paths

    trees = defaultdict(list)
    for i, s, t in rows:
        hit = i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 == 0
        trees[s].append((i is not None, i or 0, plain_leaf(i, s, t), plain_leaf(i, s, t, lower(t) if hit else t)))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    below = {s: proofs([x[2] for x in sorted(trees[s])]) for s in names}
    root, above = proofs([below[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for (known, i, leaf, tampered), path in zip(sorted(trees[s]), below[s][1]):
            path, h = path + up, tampered
            for left, right in path:
                h = sha(left, h, right)
            out.append((i if known else None, leaf, below[s][0], root, sha(*[a + b for a, b in path]), h, h == root))
    return sorted(out, key=str)


def manifest_rows(df):
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_manifest_equals_brute_force(spark):
    rnd = random.Random(3)
    names = [None, "", "a", "é", "z" * 50] + [f"s{k}" for k in range(15)]
    ids = [rnd.choice([k, 7 * k, -k, k << 30, -(1 << 63) + k, (1 << 63) - 1 - k]) for k in range(700)]
    rows = [(i, rnd.choice(names[:3] + names), f"Text {i} Ä") for i in dict.fromkeys(ids)]
    rows += [(5_000 + k, "a", f"Dense {k}") for k in range(400)]                       # over one array of slots
    rows += [(None, rnd.choice(names[:4]), f"no id {k % 9}") for k in range(60)]         # null ids, some rows equal
    rows += [(5_001, "a", f"again {k % 4}") for k in range(40)] + [(77, "lone", None), (78, "only", "")]
    assert manifest_rows(merkle.verified_leaves(docs_of(spark, rows).repartition(6))) == plain_manifest(rows)


def test_manifest_small_tables(spark):
    for rows in ([(4, None, "One")], [(4, "a", "One"), (3, "a", None)], [(k, f"s{k}", "x") for k in range(17)], [(k, "s", "X") for k in range(17)]):
        assert manifest_rows(merkle.verified_leaves(docs_of(spark, rows))) == plain_manifest(rows)
    assert manifest_rows(merkle.verified_leaves(docs_of(spark, []))) == []


def test_manifest_finds_any_change(spark):
    rows = [(k, "ab"[k % 2], f"Doc {k}") for k in range(40)]
    changed = F.when(F.col("doc_id") == 11, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    out = merkle.manifest(docs_of(spark, rows), changed).select(
        "doc_id", F.expr("aggregate(path, tampered, (h, x) -> sha2(concat(x.left, h, x.right), 256)) = root").alias("ok"))
    assert {r.doc_id for r in out.collect() if not r.ok} == {11}


# -- uniform shards ---------------------------------------------------------------
def test_hypergeometric_draws(spark):
    n = 100_000
    for pool, marked, draws in ((30, 11, 9), (5, 5, 3), (7, 0, 7), (40, 39, 20), (1, 1, 1), (9, 4, 0)):
        got = {r.k: r["count"] for r in spark.range(n).select(shards.hypergeometric(
            *[F.lit(x).cast("bigint") for x in (pool, marked, draws)], shards.uniform(F.lit(1), "id")).alias("k")).groupBy("k").count().collect()}
        want = {k: math.comb(marked, k) * math.comb(pool - marked, draws - k) / math.comb(pool, draws)
                for k in range(max(0, draws - pool + marked), min(draws, marked) + 1)}
        assert set(got) <= set(want)
        for k, p in want.items():
            assert abs(got.get(k, 0) - n * p) <= 5 * math.sqrt(n * p * (1 - p)) + 1e-6


def test_large_draws_stay_in_range(spark):
    pool, marked, draws = 50_000_000_000, 3_125_000_000, 20_000_000
    got = [r.k for r in spark.range(64).select(shards.hypergeometric(
        *[F.lit(x).cast("bigint") for x in (pool, marked, draws)], shards.uniform(F.lit(2), "id")).alias("k")).collect()]
    mean, dev = draws / 16, math.sqrt(draws / 16 * 15 / 16)
    assert all(abs(k - mean) < 6 * dev for k in got) and abs(sum(got) / 64 - mean) < 6 * dev / 8


def test_matrix_margins_over_a_tree(spark):
    sizes = [(k, k % 5 + 1) for k in range(700)]
    n = sum(s for _, s in sizes)
    blocks = [n // 3, n // 3, n - 2 * (n // 3)]
    got = {r.node: r.row for r in shards.communication_matrix(spark.createDataFrame(sizes, "node bigint, size bigint"), blocks, 4).collect()}
    assert {k: sum(v) for k, v in got.items()} == dict(sizes)
    assert [sum(v[t] for v in got.values()) for t in range(3)] == blocks


def placed(df):
    per = defaultdict(list)
    for r in df.collect():
        per[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    return Counter({s: len(v) for s, v in per.items()})


def test_shards_keep_all_rows(spark):
    rows = [(k % 90 if k % 7 else None, "a", None if k % 11 == 0 else "Ä" * (k % 5)) for k in range(300)] + [(9, "a", "x" * 300_000)]
    docs = docs_of(spark, rows).repartition(9)
    for options in ({}, {"shards": 7, "block_rows": 5}, {"shards": 3, "block_rows": 1 << 30}):
        out = shards.sharded(docs, **options)
        assert sorted(out.columns) == sorted(docs.columns)
        per = placed(out)
        assert len(per) == options.get("shards", 16) and max(per.values()) - min(per.values()) <= 1
        assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((i, t) for i, _, t in rows)
    out = shards.shard_digests(docs)
    assert "Python" not in out._jdf.queryExecution().toString() and "Pandas" not in out._jdf.queryExecution().toString()
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, _, t in rows)
    assert Counter(tuple(r[:3]) for r in out.collect()) == want
    assert sum(placed(shards.shard_digests(docs_of(spark, rows[:5]))).values()) == 5   # fewer rows than shards
    assert shards.shard_digests(docs.limit(0)).collect() == []


def test_shuffle_is_uniform(spark):
    """Rows of every part of the input, equal texts too, fall evenly on shards and slots."""
    docs = docs_of(spark, [(k, "a", "same") for k in range(4_000)]).repartitionByRange(8, "doc_id")
    out = shards.sharded(docs, shards=8).select("doc_id", "shard", "slot").collect()
    for low in range(0, 4_000, 500):
        per = Counter(r.shard for r in out if low <= r.doc_id < low + 500)
        assert sum((per[s] - 62.5) ** 2 / 62.5 for s in range(8)) < 30       # chi-square of 7 degrees
    place = {r.doc_id: r.shard * 500 + r.slot for r in out}
    rising = sum(place[k] < place[k + 1] for k in range(3_999))
    assert abs(rising - 2_000) < 6 * math.sqrt(4_000 / 12)


def test_written_shards(spark, tmp_path):
    docs = docs_of(spark, [(k, "a", str(k)) for k in range(100)])
    shards.write_shards(docs, str(tmp_path / "out"), shards=4, block_rows=10)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert placed(back) == Counter({s: 25 for s in range(4)})
