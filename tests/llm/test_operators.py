"""Each operator against a brute-force version on rows with every oddity, on an empty
table, and with extra columns whose names clash with its own."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docrel.llm import (exact_dedup, langid, mixing, order_minhash, packing, quality, secret_scan, simhash,
                        surrogates, token_counts, tokens)

from .conftest import odd_rows

ROWS = odd_rows()
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def key(row):
    return tuple((v is None, str(v)) for v in row)


def multiset(rows):
    return Counter(tuple(r) for r in rows)


# exact dedup -------------------------------------------------------------------
def by_text():
    groups = defaultdict(list)
    for r in ROWS:
        groups[SPACE.sub(" ", r[1] or "")].append(r[0])
    return groups


@pytest.mark.parametrize("tracked", [exact_dedup.TRACKED, 8])
def test_exact_groups(odd, monkeypatch, tracked):
    monkeypatch.setattr(exact_dedup, "TRACKED", tracked)
    got = exact_dedup.membership(odd).collect()
    groups = by_text()
    assert len(got) == len(ROWS)
    want = {}
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        want[hashlib.sha256(text.encode()).hexdigest()] = (min(known) if known else None, len(ids))
    assert all((r.keep_id, r.group_size) == want[r.text_sha256] for r in got)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_heavy_digests_are_settled_in_map_tasks(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same  text', concat('t', id)) as text")
    got = exact_dedup.membership(df).filter("group_size > 1").agg(
        F.count("*"), F.min("keep_id"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(got) == (1000, 0, 1)
    keys = df.select(F.xxhash64(exact_dedup.digest("text")).alias("h64"))
    heavy = exact_dedup.frequent(keys, "h64", tracked=64)
    assert df.filter(F.xxhash64(exact_dedup.digest("text")).isin(heavy)).count() >= 1000


def test_exact_rows_stay_whole(odd):
    clash = odd.withColumn("dedup_sha", F.lit("x")).withColumn("keep_id", F.lit(3)).withColumn("h64", F.lit(1))
    out = exact_dedup.deduplicated(clash)
    assert out.columns == clash.columns
    kept = out.collect()
    assert len(kept) == len(by_text())
    assert not multiset(kept) - multiset(clash.collect())


# SimHash -----------------------------------------------------------------------
def brute_simhash(text):
    words = SPACE.sub(" ", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=3):
    names = sorted(set(fps))
    root = {f: f for f in names}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    return {f: find(f) for f in names}


def test_simhash_components(odd):
    got = simhash.grouped(odd).collect()
    fps = {r[1]: brute_simhash(r[1]) for r in ROWS}
    root = brute_components(list(fps.values()))
    best = {}
    for r in ROWS:
        c = root[fps[r[1]]]
        best[c] = min([x for x in (best.get(c), r[0]) if x is not None], default=None)
    want = Counter((r[0], f"{fps[r[1]]:016x}", best[root[fps[r[1]]]]) for r in ROWS)
    assert multiset(got) == want


def clustered_fingerprints():
    """Chains and balls of fingerprints around random centres, some in one large bucket."""
    r = np.random.default_rng(3)
    out = []
    for size in (1, 2, 5, 40, 400):
        for _ in range(3):
            centre = int(r.integers(0, 2 ** 63))
            for _ in range(size):
                f = centre
                for b in r.integers(0, 64, int(r.integers(0, 5))):
                    f ^= 1 << int(b)
                out.append(f)
                if r.random() < 0.05:
                    centre = f
    return out


def test_simhash_links_are_complete(spark):
    fps = sorted(set(clustered_fingerprints()))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    from docrel.llm.components import components
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.links(nodes).collect()
    assert all(((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3 for a, b in found)
    assert len(found) < 20 * len(fps)
    roots = {r.node: r.root for r in components(spark.createDataFrame(found, "u long, v long")).collect()}
    want = brute_components(fps)
    groups = defaultdict(set)
    for f, s in zip(fps, signed):
        groups[want[f]].add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_simhash_hot_buckets_are_split(spark, monkeypatch):
    """Fingerprints that agree in 26 bits: no task gets more than a bound of them, no link is lost."""
    from docrel.llm.components import components
    r = np.random.default_rng(8)
    hot = simhash.blocks(3)[4]
    free = [i for i in range(64) if not hot >> i & 1]
    fps = set()
    for _ in range(1500):  # in one bucket, few bits apart from a neighbour each
        f = int(r.integers(0, 2 ** 63)) & ~hot | (0x123456789ABCDEF0 & hot)
        fps |= {f} | {f ^ sum(1 << int(b) for b in r.choice(free, n, replace=False)) for n in (1, 3, 5)[:r.integers(0, 4)]}
    fps = sorted(fps | {int(x) for x in r.integers(0, 2 ** 63, 200)})
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    whole = simhash.links(nodes)
    monkeypatch.setattr(simhash, "BUCKET_BOUND", 64)
    parts = simhash.bucketed(nodes)
    assert len(parts) > 1
    for part in parts:
        assert part.groupBy("choice", "bucket").count().agg(F.max("count")).first()[0] <= 64
        task = part.repartition(32, "choice", "bucket").groupBy(F.spark_partition_id()).count()
        n = [x["count"] for x in task.collect()]
        assert max(n) < sum(n) / 4
    split = simhash.links(nodes).collect()
    assert all(((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3 for a, b in split)
    roots = [{x.node: x.root for x in components(y).collect()} for y in
             (whole, spark.createDataFrame(split, "u long, v long"))]
    assert roots[0] == roots[1]
    want = brute_components(fps)
    assert len({want[f] for f in fps}) == len(fps) - len(roots[0])


def test_components_of_chains(spark):
    from docrel.llm.components import components
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 100), (100, 300), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {200: 100, 300: 100}


def test_simhash_keeps_one_of_each(odd):
    clash = odd.withColumn("fp", F.lit(1)).withColumn("component_id", F.lit(2))
    out = simhash.deduplicated(clash)
    assert out.columns == clash.columns
    kept = out.collect()
    root = brute_components([brute_simhash(r[1]) for r in ROWS])
    assert Counter(root[brute_simhash(r.text)] for r in kept) == Counter(set(root.values()))
    assert not multiset(kept) - multiset(clash.collect())


# packing -----------------------------------------------------------------------
def full_ids(text):
    from tokenizers import Tokenizer
    t = full_ids.t = getattr(full_ids, "t", None) or Tokenizer.from_file(tokens.default_path())
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def check_packed(got, ids_of, sequence=2048):
    """Every id in one piece, right checksums, gapless sequences, little padding."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        docs[(r.doc_id, r.doc_tokens)].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at and n > 0
            at += n
        assert at <= sequence
    used = sum(r.length for r in got)
    padded = sum(n if (n := sum(x for _, x in p)) & (n - 1) == 0 else sequence for p in seqs.values())
    assert padded == used
    pieces = Counter()
    for r in got:
        pieces[(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
    for rid, n in Counter((r[0], r[1]) for r in ids_of).items():
        ids = full_ids(rid[1])
        mine = [p for p in pieces if p[0] == rid[0] and p[4] == len(ids)
                and p[3] == zlib.crc32(np.array(ids[p[1]:p[1] + p[2]], "<u4").tobytes())]
        # repeated rows may be cut in different places
        cover = Counter()
        for p in mine:
            for i in range(p[1], p[1] + p[2]):
                cover[i] += pieces[p]
        assert set(cover.values()) == {n} and len(cover) == len(ids), rid[0]


def test_packing(odd):
    got = packing.pieces(odd, group_docs=16).collect()
    check_packed(got, ROWS)
    assert multiset(got) == multiset(packing.pieces(odd.repartition(3), group_docs=16).collect())


@pytest.mark.parametrize("words_each", [90, 1])
def test_packing_splits_equal_rows(spark, words_each):
    text = " ".join(["stone"] * words_each)
    df = spark.range(0, 24_000, 1, 16).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit(text + " "), F.col("id"))).otherwise(text).alias("text"))
    got = packing.pieces(df, group_docs=256).withColumn(
        "g", F.shiftright("sequence_id", packing.PLACE_BITS)).groupBy("g").agg(
        F.sum("length").alias("n"), F.sum(F.when(F.col("start") == 0, 1).otherwise(0)).alias("docs")).collect()
    docs = sorted(r.docs for r in got)
    assert sum(docs) == 24_000 and docs[-1] <= 2 * docs[len(docs) // 2]
    assert sum(r.n for r in got) == sum(8_000 * [words_each + 1]) + sum(
        words_each + 1 + len(str(i)) for i in range(24_000) if i % 3)


def test_packing_splits_a_long_text(spark):
    df = spark.createDataFrame([(1, "stone " * (2048 * 200))], "doc_id long, text string")
    got = packing.pieces(df).collect()
    check_packed(got, [tuple(r) for r in df.collect()])
    groups = Counter(r.sequence_id >> packing.PLACE_BITS for r in got)
    assert max(groups.values()) <= packing.WHOLE_GROUP and len(got) == 201


def test_packing_assigns_to_the_lowest_cost():
    placed, room = packing.assign([1000, 900, 800, 700, 600, 96])
    assert sum(room) == 4096 and len(placed) >= 6
    first = {d: s for d, start, n, s in placed if start == 0}
    assert first[0] != first[1] and first[1] == first[2]  # 900 + 800 costs less than 1000 + 800
    one = packing.assign([5])
    assert one == ([(0, 0, 4, 0), (0, 4, 1, 1)], [4, 1])
    assert packing.assign([]) == ([], [])


# mixing ------------------------------------------------------------------------
def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mixing(odd):
    got = mixing.report(odd).collect()
    assert len(got) == len(ROWS)
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += words(r[1])
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    source = {(r[0], words(r[1])): r[3] for r in ROWS}
    taken, largest = Counter(), Counter()
    for r in got:
        s = source[(r.doc_id, r.size)]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in names:  # rows with the same id and text go together: at most two here
        assert abs(taken[s] - target[s]) <= 2 * largest[s] + 1
    assert multiset(got) == multiset(mixing.report(odd.repartition(5)).collect())


def test_mix_takes_effect(odd):
    clash = odd.withColumn("taken", F.lit(9)).withColumn("mix_text", F.lit(1)).withColumn("pattern", F.lit("p"))
    out = mixing.applied(clash)
    assert out.columns == clash.columns
    times = Counter((r["doc_id"], r["text"]) for r in out.collect())
    rows, _, _ = mixing.mixed(odd, F.array("source"))
    want = Counter()
    for r in rows.collect():
        if r["taken"]:
            want[(r["id"], r["tie"])] += r["taken"] // r["size"]
    ties = {(r["doc_id"], r["text"]): r["tie"] for r in
            odd.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")).collect()}
    assert Counter({(k[0], ties[k]): n for k, n in times.items()}) == want


def test_flow_of_overlapping_sources():
    # the shared pattern can serve both; repetition is used only where sizes do not reach
    patterns = [(("a",), 100), (("b",), 20), (("a", "b"), 50)]
    assert mixing.route(patterns, {"a": 100.0, "b": 70.0}) == [100, 20, 50]
    assert mixing.route(patterns, {"a": 120.0, "b": 20.0}) in ([100, 20, 20], [70, 20, 50], [100, 0, 40])
    given = mixing.route(patterns, {"a": 0.0, "b": 100.0})
    assert given[0] == 0 and given[1] + given[2] == 100 and given[1] <= 40
    assert sum(mixing.route(patterns, {"a": 1e6, "b": 1e6})) == 340
    assert mixing.route([], {}) == []


def test_overlapping_documents(spark):
    rows = [(i, "w " * 10, ["a"] if i % 3 else ["a", "b"]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    out, sizes, quotas = mixing.mixed(df, F.col("of"), lambda s: {"a": 1.0, "b": 1.0}, share=0.5)
    assert sizes == {"a": 3000, "b": 1000} and quotas == {"a": 750.0, "b": 750.0} or sum(quotas.values()) == 1500
    by = {tuple(r["pattern"]): r["t"] for r in out.groupBy("pattern").agg(F.sum("taken").alias("t")).collect()}
    assert abs(sum(by.values()) - 1500) <= 20 and by[("a", "b")] >= 740


# token counts ------------------------------------------------------------------
def test_token_counts_after_edits(odd):
    got = token_counts.report(odd).collect()
    want = Counter()
    for doc, text, *_ in ROWS:
        text = text or ""
        n = len(text)
        new = text[:n // 3] + text[:20] + text[min(n, n // 3 + 40):]
        at = min(max(n - 30, 0), len(new))
        new = new[:at] + new[at + 10:]
        want[(doc, len(full_ids(text)) - 1, len(full_ids(new)) - 1, len(new),
              hashlib.sha256(new.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.edited_tokens, r.edited_chars, r.edited_sha256) for r in got) == want
    long = [r for r in got if r.edited_chars > 100_000]
    assert long and all(r.encoded_chars < 4000 and r.nodes_set < 60 for r in long)


def test_random_edits_keep_the_tree_right():
    import random
    r, w = random.Random(5), tokens.WordTokens(tokens.default_path())
    for trial in range(40):
        text = "".join(r.choice(["ab", "c", " ", " ", "\n", "it's", "9", "ß", "中", ".", "<|endoftext|>"])
                       for _ in range(r.randrange(0, 300)))
        starts = token_counts.leaf_starts(text, 4)
        tree = token_counts.build([w.count(text[a:b]) for a, b in zip(starts, [*starts[1:], len(text)])])
        starts = np.array(starts, np.int32)
        for _ in range(8):
            at, n = r.randrange(0, len(text) + 3), r.randrange(0, 30)
            text, _, _ = token_counts.edit(text, starts, tree, at, n, r.choice(["", " ", "x", "a b c d e f"]), w.count)
            assert token_counts.total(tree) == len(full_ids(text)) - 1
            assert (np.diff(starts) >= 0).all() and starts[-1] <= len(text)


@pytest.mark.parametrize("kind", ["base64", "code", "chinese", "few blanks"])
def test_edits_of_unspaced_texts_stay_local(kind):
    import random
    r, w = random.Random(6), tokens.WordTokens(tokens.default_path())
    letters = [chr(c) for c in range(0x4e00, 0x4e40)]
    unit = {"base64": lambda: r.choice("ABCdefGHIjkl0123456789+/"),
            "code": lambda: r.choice(["var a=", "f(x);", "if(b){", "it's", "}", "0x1f", "''", "ab,", "y.z"]).replace(" ", ""),
            "chinese": lambda: r.choice(letters) if r.random() < 0.9 else r.choice("，。"),
            "few blanks": lambda: "x" * 500 + " "}[kind]
    text = ""
    while len(text) < (1_000_000 if kind != "chinese" else 100_000):
        text += "".join(unit() for _ in range(1000))
    starts = token_counts.leaf_starts(text)
    tree = token_counts.build([w.count(text[a:b]) for a, b in zip(starts, [*starts[1:], len(text)])])
    starts = np.array(starts, np.int32)
    assert token_counts.total(tree) == w.count(text)
    for _ in range(6):
        at = int(r.choice(starts)) + r.choice([-1, 0, 0, 1, 300])
        text, encoded, _ = token_counts.edit(text, starts, tree, at, r.randrange(3), r.choice(["", "'s", "7", " ", "q", "，"]),
                                             w.count)
        assert encoded < 4000 and token_counts.total(tree) == w.count(text)


def test_random_edits_of_long_leaves(monkeypatch):
    import random
    monkeypatch.setattr(token_counts.leaf_starts, "__defaults__", (3, 4))
    r, w = random.Random(7), tokens.WordTokens(tokens.default_path())
    bits = ["ab", "c", " ", "'", "'s", "l", "9", "é", "e\u0301", "\u0301", "中", ".", ",", "<|endoftext|>", "<", "|", "-", "²", "。"]
    for _ in range(150):
        text = "".join(r.choice(bits) for _ in range(r.randrange(0, 80)))
        starts = token_counts.leaf_starts(text)
        tree = token_counts.build([w.count(text[a:b]) for a, b in zip(starts, [*starts[1:], len(text)])])
        starts = np.array(starts, np.int32)
        assert token_counts.total(tree) == len(full_ids(text)) - 1, text
        for _ in range(8):
            at, n = r.randrange(0, len(text) + 3), r.randrange(0, 9)
            text, _, _ = token_counts.edit(text, starts, tree, at, n, "".join(r.choices(bits, k=r.randrange(3))), w.count)
            assert token_counts.total(tree) == len(full_ids(text)) - 1, text
            assert (np.diff(starts) >= 0).all() and starts[-1] <= len(text)


def test_token_ids_match_the_tokenizer():
    w = tokens.WordTokens(tokens.default_path())
    every = ["".join(map(chr, range(256))), " ".join(map(chr, range(256))), "ΑΣ İ ſ K", "!'s ''S x'll"]
    for text in every + [r[1] or "" for r in ROWS]:
        assert w.ids(text).tolist() == full_ids(text)[:-1]
        assert w.count(text) == len(full_ids(text)) - 1


# language ----------------------------------------------------------------------
def test_codewords_are_distinct():
    for n in (1, 2, 3, 4, 5, 9, 40):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n
        if n > 2:
            apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
            assert min(apart) >= (2 if n > 3 else 1)


def test_language_oddities(odd):
    got = {(r.doc_id, r.lang_pred): r for r in langid.identified(odd).collect()}
    for doc in (5, 6, 7, 8):
        assert (doc, "und") in got and got[doc, "und"].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    for (doc, _), r in got.items():
        assert r.held_out == (doc is None or zlib.crc32(str(doc).encode()) % 5 == 0)


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n > 0.97


def test_language_filter_keeps_rows(odd):
    clash = odd.withColumn("lang_pred", F.lit("zz")).withColumn("langid_0", F.lit("y"))
    out = langid.accepted(clash)
    assert out.columns == clash.columns
    want = Counter(r[0] for r in ROWS if any(c.isalpha() for c in r[1] or ""))
    assert Counter(r.doc_id for r in out.collect()) == want


# secrets -----------------------------------------------------------------------
def brute_secrets(text):
    out = []
    for kind, rule, ok in (
            ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                                  re.I | re.A), lambda m: len(m[2]) >= 8),
            ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
            ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32)):
        out += [(m.start(), ("assign", "access", "hex").index(kind), kind, m.end()) for m in rule.finditer(text) if ok(m)]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


TRICKY = ["password: secret: abcdefghij", "TOKEN='abcdefgh' api_key=12345678 apikey:short", "AKIA" + "A" * 11,
          "AKIAAKIA" + "B" * 9, "f" * 31 + "g" + "0" * 32, "secret=token=abcdefgh1", "passwd  =  \"xxxxxxxxé", "ſecret=12345678",
          "-----BEGIN RSA PRIVATE KEY-----\nabc=\n-----END RSA PRIVATE KEY-----", "😀 token: abcdefgh"]


def test_secrets(spark, odd):
    df = odd.unionByName(spark.createDataFrame([(1000 + i, t, None, None, None) for i, t in enumerate(TRICKY)],
                                               odd.schema))
    got = secret_scan.report(df).collect()
    want = Counter()
    for doc, text, *_ in df.collect():
        spans = brute_secrets(text or "")
        n = Counter(s.split(":")[0] for s in spans)
        want[(doc, n["assign"], n["access"], n["hex"], hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    by = {r.doc_id: r.spans for r in got}
    assert by[1008].startswith("private_key:0:") and all(s in by[15] for s in brute_secrets(dict((r[0], r[1]) for r in ROWS)[15]))


def test_ledger_scans_only_what_is_new(spark, tmp_path, monkeypatch):
    ledger = str(tmp_path / "ledger")
    rows = [("a.py", 1, "token = abcdefgh1"), ("a.py", 2, "nothing"), ("b.py", 1, "token = abcdefgh1")]
    df = spark.createDataFrame(rows, "path string, version int, text string")
    scan = lambda d, **kw: secret_scan.scan_versions(d, ledger, path_cols=["path", "version"], **kw).collect()
    first = scan(df)
    assert {(r.path, r.version): len(r.findings) for r in first} == {("a.py", 1): 1, ("a.py", 2): 0, ("b.py", 1): 1}
    assert spark.read.parquet(ledger).count() == 2
    more = df.unionByName(spark.createDataFrame([("c.py", 3, "token = abcdefgh1"), ("c.py", 4, "secret: 12345678")], df.schema))
    again = scan(more)
    assert {(r.path, r.version): len(r.findings) for r in again}[("c.py", 3)] == 1
    assert spark.read.parquet(ledger).count() == 3
    scan(more, rules="2")
    assert spark.read.parquet(ledger).groupBy("rules").count().orderBy("rules").collect()[1]["count"] == 3


# surrogates --------------------------------------------------------------------
PERSONAL = [(1, "Mail Foo.Bar@Example.com or foo.bar@example.com. Call +1 (743) 555-3824 now."),
            (2, "Dear Mr. John Smith, Ms Mary SMITH; Dr Jones. Mr. Smith! card 4785380592391139 or 4785-3805-9239-1139, "
                "ip 8.196.197.208."), (3, None), (4, ""), (None, "SSN 123-45-6789; Frau Müller; Госпожа Анна Петрова x@y.zz"),
            (5, "FOO.BAR@EXAMPLE.COM 743-555-3824 (743) 555-3824 1.2.3.4.5 999.1.1.1"), (5, "FOO.BAR@EXAMPLE.COM")]


def test_surrogates_match_and_agree(spark):
    df = spark.createDataFrame(PERSONAL, "doc_id long, text string").withColumn("table", F.lit(1)).withColumn("h", F.lit(2))
    got = surrogates.scrubbed(df, "k").collect()
    assert len(got) == len(PERSONAL)
    texts = [r.text for r in got]
    everything = "\n".join(texts).lower()
    for real in ("foo.bar", "555-3824", "smith", "jones", "4785380592391139", "8.196.197.208", "123-45-6789", "müller", "петров"):
        assert real not in everything, real
    one = next(t for t in texts if t.startswith("Mail"))
    a, b = re.findall(r"[\w.]+@[\w.]+(?=[ .])", one)[:2]
    assert a.rstrip(".") == b.rstrip(".") and a.upper().rstrip(".") in everything.upper()
    two = next(t for t in texts if t.startswith("Dear"))
    m = re.match(r"Dear Mr\. (\w+) (\w+), Ms (\w+) (\w+); Dr (\w+)\. Mr\. (\w+)! card (\d{16}) or ([\d-]{19}), ip ([\d.]+)\.", two)
    assert m and m[2].upper() == m[4] and m[2] == m[6] and m[5] != m[2] and m[7] == m[8].replace("-", "")
    assert m[1] in surrogates.GIVEN["m"][0] and m[3] in surrogates.GIVEN["f"][0]
    ru = next(t for t in texts if t.startswith("SSN"))
    assert re.match(r"SSN \d{3}-\d{2}-\d{4}; Frau [A-Z][a-z]{5}; Госпожа [А-Я][а-яё]+ [А-Я][а-я]+ \w@\w\.zz", ru)
    assert "1.2.3.4.5 999.1.1.1" in everything
    assert [tuple(r) for r in got if r.doc_id in (3, 4)] == [(3, 0, 0, ""), (4, 0, 0, "")]
    assert multiset(got) == multiset(surrogates.scrubbed(df, "k").collect())
    other = "\n".join(r.text for r in surrogates.scrubbed(df, "other").collect())
    assert a not in other


def test_surrogates_stay_distinct_in_a_crowded_space(spark):
    names = [(f"given_{g}", f"Name{i}") for i in range(150) for g in "fm"]
    mails = [("email", f"{c}@{d}.io") for c in "abcdefgh" for d in "abcdefgh"]
    known = surrogates.surrogates(spark.createDataFrame(names + mails, "kind string, entity string"), F.lit("k")).collect()
    assert len(known) == len(names) + len(mails)
    assert len({(r.kind.split("_")[0], r.surrogate) for r in known}) == len(known)
    assert not {r.surrogate for r in known} & {e for _, e in mails}


LONG_NAMES = [
    (1, "Mr John Fitzgerald Kennedy met Mr Kennedy, Mr. Ludwig van Beethoven and MR JOHN KENNEDY."),
    (2, "Dr. J. Smith, Dr J.R.R. Smith, Herr Dr. Hans Smith; Mr Smith's dog, Ms Anna Maria de la Cruz Smith Jr. left."),
    (3, "Mr d'Artagnan saw Mrs O'Brien and Mr T"), (4, "Mr John Smith Mrs Mary Smith"), (5, "MR " + "Aa Bb " * 3000 + "Smith")]


def test_surrogates_cover_whole_names(spark):
    got = {r.doc_id: r for r in surrogates.scrubbed(spark.createDataFrame(LONG_NAMES, "doc_id long, text string"), "k").collect()}
    everything = " ".join(r.text for r in got.values()).lower()
    for real in ("john", "fitzgerald", "kennedy", "ludwig", "beethoven", "smith", "hans", "anna", "maria", "cruz",
                 "artagnan", "brien", "mary"):
        assert not re.search(rf"\b{real}", everything), real
    m = re.fullmatch(r"Mr (\w+) (\w+) (\w+) met Mr (\w+), Mr\. (\w+) van (\w+) and MR ([A-Z]+) ([A-Z]+)\.", got[1].text)
    assert m and m[3] == m[4] == m[8].capitalize() and m[1] == m[7].capitalize() and len({m[1], m[2], m[3], m[5], m[6]}) == 5
    assert {m[1], m[2], m[5]} <= set(surrogates.GIVEN["m"][0]) and got[1].n_mentions == 4
    m = re.fullmatch(r"Dr\. ([A-Z]\w*)\. (\w+), Dr ([A-Z]\w*)\.([A-Z]\w*)\.([A-Z]\w*)\. (\w+), Herr Dr\. (\w+) (\w+); "
                     r"Mr (\w+)'s dog, Ms (\w+) (\w+) de la (\w+) (\w+) Jr\. left\.", got[2].text)
    assert m and m[2] == m[6] == m[8] == m[9] == m[13] and m[1] == m[3] and m[4] == m[5] != m[3]
    assert m[7] in surrogates.GIVEN["m"][0] and m[10] in surrogates.GIVEN["f"][0]
    assert re.fullmatch(r"Mr \w'\w+ saw Mrs \w'\w+ and Mr [A-Z]\w*", got[3].text) and got[4].n_mentions == 2
    assert got[5].n_entities == 3 and len(got[5].text.split()) == 6002


NUMBERS = ["+44 20 7946 0958", "+442079460958", "+49 30 123456", "+33 1 42 68 53 00", "+49 (0)89/1234567", "5551234567",
           "+15551234567", "+1 743-555-3824", "3782 822463 10005", "378282246310005", "4785 3805 9239 1139", "+86 138 0013 8000",
           "+123456789012345", "+4785 3805 9239 1139", "+4785380592391139"]


def test_surrogates_cover_other_numbers(spark):
    kept = "1.5 GMT+2 2024-01-01 +1234567 1234567890123 2.2222222222 x5551234567 a.b. 3-4-5 +44 20 7946 0958 7 apples"
    texts = NUMBERS + [" .bob@x.com, ...eve@x.com", kept, "+33 1 42 68 53 00"]
    got = {r.doc_id: r for r in surrogates.scrubbed(
        spark.createDataFrame([(i, f"a {t} b") for i, t in enumerate(texts)], "doc_id int, text string"), "k").collect()}
    news = [got[i].text[2:-2] for i in range(len(texts))]
    for old, new in zip(NUMBERS, news):
        assert new != old and re.sub("[0-9]", "0", new) == re.sub("[0-9]", "0", old), (old, new)
    assert all(got[i].n_mentions == 1 for i in range(len(NUMBERS)))
    assert news[0].replace(" ", "") == news[1] and news[3] == news[-1] and news[8].replace(" ", "") == news[9]
    assert news[0].startswith("+44 ") and news[8][0] == "3"
    m = re.fullmatch(r" \.(\w+@\w+)\.com, \.\.\.(\w+@\w+)\.com", news[-3])
    assert m and m[1] != "bob@x" and m[2] != "eve@x" and got[len(NUMBERS)].n_mentions == 2
    assert news[-2] == kept.replace(NUMBERS[0], news[0]) and got[len(NUMBERS) + 1].n_mentions == 1


def test_surrogates_settle_the_gender_of_given_names(spark):
    texts = ["Dr Anna Smith, Mrs Anna Smith", "Prof Anna Jones", "Prof Boris Jones", "Mr Boris Smith", "Dr Robin Gray",
             "Mrs Robin Gray", "Mr Robin Gray", "Mr Robin Gray", "Dr Cleo Gray"]
    got = {r.doc_id: r for r in surrogates.scrubbed(
        spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), "k").collect()}
    given = {i: [m[1] for m in re.finditer(r"[A-Z][a-z]+ (\w+) \w+", r.text)] for i, r in got.items()}
    female, male = surrogates.GIVEN["f"][0], surrogates.GIVEN["m"][0]
    assert given[0][0] == given[0][1] == given[1][0] and given[0][0].startswith(tuple(female))
    assert given[2] == given[3] and given[2][0].startswith(tuple(male))
    assert given[4] == given[6] == given[7] != given[5] and given[5][0].startswith(tuple(female))
    assert got[0].n_entities == 2 and got[8].n_entities == 2 and "Cleo" not in got[8].text


# quality -----------------------------------------------------------------------
def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality.scored(docs, quality.train(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in got) / len(got)
    often = sum(r.quality for r in got) / len(got)
    good = [r.predicted for r in got if r.quality == 1]
    assert len(got) > 300 and right > often and right > 0.95 and sum(good) / len(good) > 0.98


def test_quality_oddities(spark, odd):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 140)] + [(None, 1), (5, None)],
                                   "doc_id long, quality int")
    got = quality.scored(odd, quality.train(odd, labels)).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    none = quality.train(odd, labels.limit(0))
    assert quality.scored(odd, none).select("score").distinct().count() == 1


# Order MinHash -----------------------------------------------------------------
def test_order_minhash_edits(odd):
    got = order_minhash.edited_report(odd).collect()
    keyed = {(r["doc_id"], r["text"] or ""): r["h"] for r in
             odd.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(keyed, key=lambda k: (k[0] is not None, k[0] or 0, keyed[k]), reverse=True)
    edited = {}
    for i, k in enumerate(order):
        nxt, half = order[(i + 1) % len(order)][1], len(k[1]) // 2
        edited[k] = k[1][:len(k[1]) - half] + nxt[:half]
    want = Counter((r[0], len(r[1] or ""), hashlib.sha256(edited[r[0], r[1] or ""].encode()).hexdigest()) for r in ROWS)
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_order_minhash_definition(spark):
    texts = ["", "a", "a b", "a b c", "a b c a b c a b c", " ".join(f"w{i % 37}" for i in range(2000)),
             " ".join(f"u{i}" for i in range(700)), "x y " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.s for r in order_minhash.with_sketch(df, F.col("text"), "s").collect()}
    mask = order_minhash._PLACE

    def hashes(rows, *kinds):
        n, cols = len(kinds), ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))
        d = spark.createDataFrame([tuple(r) + (None,) * (n - len(r)) for r in rows], cols)
        return [r[0] for r in d.select(F.xxhash64(*d.columns)).collect()]

    for k, text in enumerate(texts):
        w = text.split()
        n = max(len(w) - 2, min(len(w), 1))
        h = hashes([w[i:i + 3] for i in range(n)], *["string"] * 3) if n else []
        seen, numbered = Counter(), []
        for x in h:
            numbered.append((x >> 27, seen[x >> 27]))
            seen[x >> 27] += 1
        again = hashes([(a, o) for a, o in numbered], "long", "int") if n else []
        value = [((x if o == 0 else y) & ~mask) | i for i, (x, y, (_, o)) in enumerate(zip(h, again, numbered))]
        sig = []
        for i in range(64):
            turn = i << 58
            turn = turn - (1 << 64) if turn >> 63 else turn
            two = sorted(value, key=lambda v: v ^ turn)[:2]
            sig.append([v >> 27 for v in sorted(two, key=lambda v: v & mask)])
        want = "".join(f"{x & 0xFFFF:04x}" for x in hashes(sig, "long", "long"))
        assert got[k] == want, k


def test_order_matters(spark):
    a = [f"w{i}" for i in range(400)]
    b = a[200:] + a[:200]
    rows = [(" ".join(a), " ".join(a[:390] + ["x"] * 10)), (" ".join(a), " ".join(b))]
    df = spark.createDataFrame(rows, "a string, b string")
    df = order_minhash.with_sketch(order_minhash.with_sketch(df, F.col("a"), "sa"), F.col("b"), "sb")
    near, turned = [r[0] for r in df.select(order_minhash.likeness("sa", "sb")).collect()]
    assert near > 0.8 and turned < 0.75


# empty tables ------------------------------------------------------------------
def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for out in (exact_dedup.membership(none), exact_dedup.deduplicated(none), simhash.grouped(none),
                simhash.deduplicated(none), packing.pieces(none), mixing.report(none), mixing.applied(none),
                token_counts.report(none), langid.identified(none), langid.accepted(none), secret_scan.report(none),
                surrogates.scrubbed(none, "k"), quality.scored(none, quality.train(none, labels)),
                order_minhash.edited_report(none)):
        assert out.count() == 0
