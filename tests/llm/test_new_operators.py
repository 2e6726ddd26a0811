"""Collocations, rendezvous sharding and alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docrel.llm import alignment, collocations, pair_hash, queries, sharding
from docrel.llm import transducers as tr
from tests.harness import compare, duck

from .conftest import odd_rows

ROWS = odd_rows()
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    info = compare(spark, name, SF, queries.queries()[name], queries.oracle_sql()[name], duck(SF))
    assert info["ok"], info


# collocations ------------------------------------------------------------------
def brute_collocations(rows, least, inside, best):
    f = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {s for p, a in cands.items() if len(p) == 3 for s in (p[:2], p[1:]) if 100 * a >= inside * c[s]}
        found = []
        for p, a in cands.items():
            if p not in gone:
                score, _, l, r = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]])
                                     for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        n = sum(v for p, v in c.items() if len(p) == 1)
        out += [(lang, i, x[2].decode(), -x[1], x[3], x[4], n, -x[0]) for i, x in enumerate(sorted(found)[:best], 1)]
    return sorted(out)


@pytest.mark.parametrize("least,n_ranges,shard_words", [(10, None, 1 << 21), (2, 40, 300), (3, 1, 7)])
def test_collocations(odd, least, n_ranges, shard_words):
    got = collocations.collocations(odd, least=least, n_ranges=n_ranges, shard_words=shard_words).collect()
    want = brute_collocations(ROWS, least, 50, 2000)
    assert sorted(map(tuple, got)) == want and len(want) > 20


def test_collocations_keep_the_best_and_drop_the_inner(spark):
    rows = [(i, t, None) for i, t in enumerate(["New  York city. new york City, a b\x01 c; a b\x01 c"] * 30
                                               + ["new york", "york x", "a b c? A b c!"] * 7 + [None, "", " .. \t"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("part", F.lit(1)).withColumn("kind", F.lit("x"))
    for best in (1, 3, 50):
        got = collocations.collocations(df, best=best, n_ranges=9).collect()
        assert sorted(map(tuple, got)) == brute_collocations(rows, 10, 50, best)


def test_collocations_of_nothing(none, spark):
    assert collocations.collocations(none).collect() == []
    once = spark.createDataFrame([("only once", "en")], "text string, lang string")
    assert collocations.collocations(once).collect() == []


def test_scores_beyond_64_bits():
    a, l, r = np.array([10 ** 12, 7]), np.array([3 * 10 ** 12, 9]), np.array([10 ** 13 + 1, 8])
    assert collocations.scores(a, l, r).tolist() == [10 ** 30 // (3 * 10 ** 12 * (10 ** 13 + 1)), 49_000_000 // 72]


def packed(phrases, words):
    number = {w: i + 1 for i, w in enumerate(words)}
    return [sum(number[w] << (20 * (2 - d)) for d, w in enumerate(p)) for p in phrases]


def test_transducers_share_states_and_keep_weights():
    r = random.Random(3)
    names = [b"%c" % c for c in range(97, 117)]
    for _ in range(25):
        counts = Counter(tuple(r.choice(names) for _ in range(r.choice([1, 2, 3, 3, 3]))) for _ in range(r.choice([0, 1, 30, 800])))
        parts = [Counter({p: n for p, n in counts.items() if r.random() < 0.6}) for _ in range(4)]
        made = []
        for c in parts:
            keys = sorted((k, n) for k, n in zip(packed(c, names), c.values()))
            levels = tr.levels_of(np.array([k for k, _ in keys], np.int64), np.array([n for _, n in keys], np.int64), 20, 3)
            t = tr.Transducer.unpacked(*tr.build(names, levels).packed())
            made.append(t)
            arcs = [tuple(zip(t.label[i:j], t.weight[i:j], t.target[i:j])) for i, j in zip(t.first, t.first[1:])]
            depth = {len(arcs) - 1} - {0}
            while depth:  # no two states of a depth alike
                assert len({arcs[x] for x in depth}) == len(depth)
                depth = {int(to) for x in depth for *_, to in arcs[x]} - {0}
        words, levels = tr.union(made)
        want = sum(parts, Counter())
        paths, before = {}, [()]
        for parent, label, weight in levels:
            before = [before[p] + (words[x],) for p, x in zip(parent, label)]
            paths |= {p: w for p, w in zip(before, weight.tolist()) if w}
        assert paths == dict(want)
        one = tr.build(words, levels)
        assert [x[2].tolist() for x in tr.compose(words, levels, one)] == [x[2].tolist() for x in levels]
        kept = tr.union([tr.build(words, tr.pruned(levels, 3))])[1]
        assert sorted(w for x in kept for w in x[2].tolist() if w >= 3) == sorted(n for n in want.values() if n >= 3)


def test_equal_hashes_do_not_merge_states(monkeypatch):
    monkeypatch.setattr(tr, "mixed", lambda keys, seed: np.zeros(len(keys), np.uint64))
    words = [b"a", b"b", b"c"]
    phrases = {(b"a", b"a"): 1, (b"a", b"b"): 2, (b"b", b"a"): 1, (b"b", b"b"): 3, (b"c", b"c"): 1}
    keys = sorted(zip(packed(phrases, words), phrases.values()))
    levels = tr.levels_of(np.array([k for k, _ in keys], np.int64), np.array([n for _, n in keys], np.int64), 20, 3)
    got = tr.union([tr.build(words, levels)])[1]
    assert [[y.tolist() for y in x] for x in got] == [[y.tolist() for y in x] for x in levels]


# sharding ----------------------------------------------------------------------
def brute_shard(key, weights, seed=sharding.SEED):
    import math
    name = "null" if key is None else f"k{key}"
    scores = [(-math.log((int(hashlib.md5(f"{seed}|{s}|{name}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13) / w, s)
              for s, w in enumerate(weights)]
    return min(scores)[1]


def test_sharding(odd):
    got = sharding.report(odd.withColumn("shard", F.lit("x")).withColumn("at", F.lit(1))).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode()), "key",
                    brute_shard(r[0], [1] * 40), brute_shard(r[0], [1] * 41)) for r in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32))
    for s in slots.values():
        s.sort()
        assert [x[0] for x in s] == list(range(len(s))) and [x[1:] for x in s] == sorted(x[1:] for x in s)


def test_weights_and_moves(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 0.5, 4.0]
    before = {r.doc_id: r.shard for r in sharding.sharded(ids, weights=weights).collect()}
    share = Counter(before.values())
    for s, w in enumerate(weights):
        assert abs(share[s] - 20_000 * w / sum(weights)) < 400
    after = {r.doc_id: r.shard for r in sharding.sharded(ids, weights=[*weights, 1.5]).collect()}
    moved = [k for k in before if before[k] != after[k]]
    assert all(after[k] == 4 for k in moved) and abs(len(moved) - 20_000 * 1.5 / 9) < 300
    lighter = {r.doc_id: r.shard for r in sharding.sharded(ids, weights=[1.0, 2.0, 0.5, 3.0]).collect()}
    assert all(before[k] == 3 for k in before if before[k] != lighter[k])
    with pytest.raises(ValueError):
        sharding.sharded(ids, weights=[1.0, 0.0])
    with pytest.raises(ValueError):
        sharding.sharded(ids.withColumn("SHARD", F.lit(1)))


def test_sharding_of_nothing_and_of_one_key(none, spark):
    assert sharding.report(none).collect() == []
    rows = sharding.report(spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x").alias("text"))).collect()
    assert sorted(r.slot for r in rows) == list(range(5000)) and len({r.shard for r in rows}) == 1


def test_sharded_files(spark, tmp_path, odd):
    path = sharding.write_sharded(odd, str(tmp_path / "out"), weights=[1.0] * 5)
    back = spark.read.parquet(path)
    assert back.count() == len(ROWS)
    assert all(r.shard == brute_shard(r.doc_id, [1] * 5) for r in back.collect())


# perfect hash ------------------------------------------------------------------
def test_perfect_hash_is_minimal():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 100, 50_000):
        keys = np.unique(r.integers(0, 1 << 62, n))
        bucket = pair_hash.bucket_of(keys)
        f = pair_hash.PerfectHash([(b, *pair_hash.cascade(keys[bucket == b])) for b in range(pair_hash.BUCKETS)])
        assert sorted(f.index(keys).tolist()) == list(range(len(keys))) and len(f) == len(keys)
        other = f.index(r.integers(0, 1 << 62, 1000)) if n else np.array([-1])
        assert (other < max(len(keys), 1)).all()
        assert n < 100 or sum(len(pair_hash.cascade(keys)[1]) for _ in "1") * 64 < 8 * len(keys) + 1000


def test_dense_counts_are_summed_in_a_tree(spark):
    r = np.random.default_rng(2)
    want, rows = Counter(), []
    for part in range(40):
        keys = np.unique(r.integers(0, 500, 200))
        counts = r.integers(1, 70_000, len(keys))
        want.update(dict(zip(keys.tolist(), counts.tolist())))
        bucket = pair_hash.bucket_of(keys)
        rows += [(int(b), part, pair_hash.narrow(keys[bucket == b]), pair_hash.narrow(counts[bucket == b])) for b in np.unique(bucket)]
    chunks = spark.createDataFrame(rows, "bucket int, part long, keys binary, counts binary")
    for slice_keys in (10 ** 6, 60):
        table = pair_hash.table(chunks, slice_keys).collect()
        got = {}
        for t in table:
            got |= dict(zip(np.frombuffer(t.keys, "<i8").tolist(), pair_hash.widened(t.counts).tolist()))
        assert got == dict(want)


# alignment ---------------------------------------------------------------------
class Plain:
    """Whole texts through both tokenizers."""

    def __init__(self):
        from tokenizers import Tokenizer
        a, b = alignment.default_paths()
        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        _, self.raw_a = alignment._byte_level(a)
        self.b, self.raw_b, _ = alignment._pieces(b)

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        whole = (" " + text).encode()
        if b"".join(self.raw_a[x] for x in a) != whole or b"".join(self.raw_b[x] for x in b) != whole:
            return []
        at_a = np.cumsum([len(self.raw_a[x]) for x in a]).tolist()
        at_b = np.cumsum([len(self.raw_b[x]) for x in b]).tolist()
        out, i, j = [], 0, 0
        for cut in sorted(set(at_a) & set(at_b)):
            i1, j1 = at_a.index(cut, i) + 1, at_b.index(cut, j) + 1
            out.append((a[i:i1], b[j:j1]))
            i, j = i1, j1
        return out


ODD_TEXTS = [" ", "  ", "a ", " a", "a  b", "a \n b", "\n", "\n\n a\n", "a\n\nb \n", "tab\t x\t\ty", "x\r\n y \r\n", "a▁b", "▁", "é́ ﬁ 　x",
             "<|endoftext|> <s> </s> <unk> <0x41>", "it's 'S 've\n'll", "\x00 a\x00b", "\x1c \x1f y\x85 z  w\xa0 v", "12 345 6,789.0 €5",
             "中文 字 を\n かな 한국어", "😀😀 👩‍👩‍👧 x", "a" * 500, " " * 300 + "x" + "\n" * 300, "=" * 77 + " " + "-" * 99, "fooBar_baz(qux) {\n    return 1;\n}\n"]


def test_units_do_not_change_the_tokens():
    plain, own = Plain(), alignment.Tokens(*alignment.default_paths())
    of = alignment.Vocabularies(*alignment.default_paths())
    assert own.apart
    r = random.Random(4)
    random_texts = ["".join(r.choice(["a", "the", " ", " ", "\n", "\t", ".", "é", "'s", "9", "\xa0", "中", "▁", "_", "\r"])
                            for _ in range(r.randrange(1, 40))) for _ in range(1500)]
    for text in ODD_TEXTS + random_texts + [x[1] or "" for x in ROWS]:
        want = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain.groups(text))
        ids = own.of(text)
        got = "" if ids is None else alignment.Alignment(of, *ids, np.array([0, len(ids[0])]), np.array([0, len(ids[1])])).named()[0]
        assert got == want, repr(text)


@pytest.mark.parametrize("slice_keys,cached", [(alignment.SLICE_KEYS, None), (100, 20)])
def test_alignment(spark, monkeypatch, slice_keys, cached):
    if slice_keys == 100:
        monkeypatch.setattr(alignment, "MAX_UNITS", cached)
        monkeypatch.setattr(alignment, "HELD_PAIRS", 50)
        monkeypatch.setattr(alignment, "BATCH_BYTES", 300)
        monkeypatch.setattr(alignment, "_LINKS", 7)
        monkeypatch.setattr(alignment, "_SMALL", 2)
    rows = [(r[0], r[1]) for r in ROWS if len(r[1] or "") < 50_000] + [(500 + i, t) for i, t in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("own", F.lit(1)).withColumn("n_a", F.lit("x"))
    got = alignment.report(df, slice_keys=slice_keys).collect()
    plain = Plain()
    groups = [plain.groups(t) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    docs = Counter(p for x in links for p in x)
    top = defaultdict(int)
    for (a, _), n in docs.items():
        top[a] = max(top[a], n)
    want = Counter()
    for (doc, _), g, own in zip(rows, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        want[(doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()),
              sum(n for p, n in own.items() if docs[p] == top[p[0]]), sum(n * docs[p] for p, n in own.items()),
              hashlib.sha256(text.encode()).hexdigest() if g else "")] += 1
    assert Counter(map(tuple, got)) == want
    if slice_keys != 100:
        n_b = plain.b.get_piece_size()
        table = {(r.a, r.b): r.docs for r in alignment.pairs(alignment.pair_counts(alignment.token_ids(df)), n_b).collect()}
        assert table == dict(docs)


def test_large_groups_count_all_links(monkeypatch):
    of = alignment.Vocabularies(*alignment.default_paths())
    of.width_a, of.width_b, of.n_b = np.array([0, 3, 1]), np.array([0, 0, 0, 2, 1]), 10
    a, b = [2] + [1] * 40, [3] * 60 + [4]
    links = Counter()
    at_a, at_b = np.cumsum([1] + [3] * 40).tolist(), np.cumsum([2] * 60 + [1]).tolist()
    i = j = 0
    for cut in sorted(set(at_a) & set(at_b)):
        i1, j1 = at_a.index(cut) + 1, at_b.index(cut) + 1
        links.update(x * 10 + y for x in a[i:i1] for y in b[j:j1])
        i, j = i1, j1
    for small in (4096, 3):
        monkeypatch.setattr(alignment, "_SMALL", small)
        two = alignment.Alignment(of, np.array(a * 2), np.array(b * 2), np.array([0, 41, 41, 82]), np.array([0, 61, 61, 122]))
        got = [Counter(), Counter(), Counter()]
        for pair, times, text in two.links():
            for p, n, t in zip(pair.tolist(), np.broadcast_to(times, len(pair)).tolist(), text.tolist()):
                got[t][p] += n
        assert got == [links, Counter(), links] and two.n_links.tolist() == [sum(links.values()), 0, sum(links.values())]
        assert sorted(two.distinct().tolist()) == sorted([*links, *links])


def test_alignment_of_nothing(none):
    assert alignment.report(none).collect() == []
