"""Registered queries against their SQL, and the pipeline stage by stage."""

import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import TABLES, plain
from ledgerloom.llm import decontamination, line_dedup, toxicity
from ledgerloom.llm.registry import LLM_QUERIES, LLM_SQL
from ledgerloom.llm.tables import table

CONTRACT = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_simhash": ["doc_id", "fingerprint", "component_id"],
    "op4_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op6_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op9_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op11_spelling": ["word", "form", "root", "n", "n_near", "form_n"],
    "op12_syncmers": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op13_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op10_pack": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
}


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    frame = entry.queries()[name](spark, sf_dir)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    theirs = Counter(tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in cursor.fetchall())
    ours = Counter(tuple(plain(r[c]) for c in sorted(columns)) for r in frame.collect())
    assert ours == theirs


def test_every_operator_is_registered():
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in LLM_QUERIES)] == []
    assert "pipeline" in entry.queries() and set(LLM_SQL) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, sf_dir, name):
    frame = LLM_QUERIES[name](spark, sf_dir)
    assert set(CONTRACT[name]) <= set(frame.columns)


def test_pipeline_stages_keep_what_they_should(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    before = texts(docs)

    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    clean = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert clean.columns == columns
    scorer = model.scorer()
    kept = {i: t for i, t in before.items() if scorer(t or "") < toxicity.THRESHOLD}
    assert texts(clean) == kept

    lines = corpus_pipeline.drop_repeated_lines(spark, clean, sf_dir)
    assert lines.columns == columns
    holders = defaultdict(set)
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(line_dedup.SPACE))
    for i, t in kept.items():
        for line in t.split("\n"):
            holders[key(line)].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    kept = {i: "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i) for i, t in kept.items()}
    assert texts(lines) == kept
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect() if r["text"] != before[r["doc_id"]])

    single = corpus_pipeline.drop_near_duplicates(spark, lines, sf_dir)
    assert single.columns == columns
    ids = sorted(kept)
    words = [(kept[i] or "").split() for i in ids]
    sets = [{tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else {()} for w in ([x.lower() for x in ws] for ws in words)]
    root = list(range(len(ids)))
    for a, b in combinations(range(len(ids)), 2):
        common = len(sets[a] & sets[b])
        if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    kept = {i: kept[i] for i in {ids[r] for r in root}}
    assert texts(single) == kept

    unseen = corpus_pipeline.drop_benchmark(spark, single, sf_dir)
    assert unseen.columns == columns
    items = table(spark, sf_dir, "benchmark").collect()
    index = next(decontamination.indexes(table(spark, sf_dir, "benchmark")))
    assert len(index.items) == len(items)
    held = set()
    for i, t in kept.items():
        words = np.array([index.words.get(w, 0) for w in decontamination.re.findall(r"\w+", t.lower())], np.int32)
        if any(decontamination.edits(item, words) <= index.allowed(n) for n, item in enumerate(index.items)):
            held.add(i)
    kept = {i: t for i, t in kept.items() if i not in held}
    assert texts(unseen) == kept

    pieces = corpus_pipeline.pack(spark, unseen, sf_dir).collect()
    assert {p["doc_id"] for p in pieces} == set(kept)
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(p["doc_id"], p["start"], p["length"], p["ids_crc32"]) for p in whole} == {(p["doc_id"], p["start"], p["length"], p["ids_crc32"]) for p in pieces}
    assert zlib.crc32(b"") == 0


def test_pipeline_links_by_simhash_and_by_shingles(spark, make_docs):
    """Fingerprints count repeated shingles, so these two are equal to SimHash alone; two others only share most of their shingles."""
    words = lambda seed, n: " ".join(f"w{seed}x{i}" for i in range(n))
    same_print = [(4, "one two three " * 400 + words(1, 20)), (7, "one two three " * 400 + words(2, 20))]
    text = words(3, 60)
    same_set = [(9, text), (5, text.rsplit(" ", 5)[0])]
    docs = make_docs([*same_print, *same_set, (8, words(4, 60)), (None, words(5, 60))])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, 4), (False, 5), (False, 8), (True, None)]
