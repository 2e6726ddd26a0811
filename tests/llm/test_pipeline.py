"""The pipeline's stages, each against a brute-force version on its own input, and the
registered queries."""

import re
from collections import Counter

import pytest

import __spark_entry__ as E
import corpus_pipeline
from docrel.llm import langid, queries
from docrel.llm.common import stored
from tests.harness import compare, duck

from .conftest import SCHEMA, odd_rows
from .test_operators import SPACE, brute_components, brute_simhash, check_packed, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, odd):
    """Rows that each stage was given and returned."""
    out, docs = {}, odd
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, "unused"), name)
        out[name] = ([tuple(r) for r in docs.collect()], result.collect(), docs.columns, result.columns)
        docs = result
    return out


def test_stages_return_documents(stages):
    for name, (_, _, before, after) in list(stages.items())[:-1]:
        assert before == after == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_language_drops_texts_without_letters(stages):
    given, kept, *_ = stages["language"]
    assert Counter(map(tuple, kept)) == Counter(r for r in given if any(c.isalpha() for c in r[1] or ""))


def test_language_drops_what_the_classifier_cannot_tell(spark):
    letters = {"aa": "abc", "bb": "def", "cc": "ghi", "dd": "jkl"}
    rows = [(10 * i + j, " ".join([chars, chars[::-1], chars * 2] * 5), lang, "s", 5)
            for i, (lang, chars) in enumerate(letters.items()) for j in range(10)]
    rows += [(100, "z", "aa", "s", 1), (101, "z?", None, "s", 2), (102, "1 2", "bb", "s", 3), (103, "abc cba", None, "s", 7)]
    docs = spark.createDataFrame(rows, SCHEMA)
    score = {r.doc_id: r.score for r in langid.identified(docs).collect()}
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, "unused").collect()}
    assert score[100] < langid.AMBIGUOUS and 0 < score[101] < langid.AMBIGUOUS <= score[103]
    assert kept == {r[0] for r in rows} - {100, 101, 102}


def test_exact_keeps_the_smallest_id(stages):
    given, kept, *_ = stages["exact_dedup"]
    groups = {}
    for r in given:
        groups.setdefault(SPACE.sub(" ", r[1]), []).append(r)
    first = {t: min((r[0] is None, r[0] or 0) for r in rows) for t, rows in groups.items()}
    assert Counter(SPACE.sub(" ", r.text) for r in kept) == Counter(groups.keys())
    assert all((r.doc_id is None, r.doc_id or 0) == first[SPACE.sub(" ", r.text)] for r in kept)


def test_near_keeps_one_of_each_component(stages):
    given, kept, *_ = stages["near_dedup"]
    root = brute_components([brute_simhash(r[1]) for r in given])
    best = {}
    for r in given:
        c = root[brute_simhash(r[1])]
        best[c] = min(best.get(c, (2, 0)), (int(r[0] is None), r[0] or 0))
    got = {root[brute_simhash(r.text)]: (int(r.doc_id is None), r.doc_id or 0) for r in kept}
    assert len(kept) == len(best) and got == best


def test_mix_meets_its_targets(stages):
    given, kept, *_ = stages["mixing"]
    sizes, taken = Counter(), Counter()
    for r in given:
        sizes[r[3]] += words(r[1])
    for r in kept:
        taken[r.source] += words(r.text)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * sizes[s]]
        target |= {s: 2.0 * sizes[s] for s in full} or share
        left -= sum(2.0 * sizes[s] for s in full)
        open_ = open_ - set(full) if full else set()
    largest = max(words(r[1]) for r in given)
    assert all(abs(taken[s] - target[s]) <= largest for s in names)
    assert max(Counter((r.doc_id, r.text) for r in kept).values()) <= 2


def test_packing_is_an_exact_round_trip(stages):
    given, got, *_ = stages["packing"]
    check_packed(got, given)


def test_run_over_documents(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    info = compare(spark, name, SF, queries.queries()[name], queries.oracle_sql()[name], duck(SF))
    assert info["ok"], info


def test_registered():
    names = E.queries()
    for n in range(1, 11):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert "pipeline" in names and len(odd_rows()) > 50
