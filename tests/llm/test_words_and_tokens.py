"""Spelling variants, syncmer fingerprints and token alignment against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import alignment, packing, spelling, syncmers
from ledgerloom.llm.tables import table

ROW = "doc_id bigint, text string, word string, n bigint, key string, id bigint, version bigint, hashes string"


def clashing(spark, pairs):
    """Documents with columns named like those the operators make."""
    return spark.createDataFrame([(i, t, "w", 7, "k", 1, 2, "h") for i, t in pairs], ROW).repartition(3)


def edit_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(pairs):
    counts = Counter()
    for doc, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [x for x in words if edit_one(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return rows


def some_pairs(seed, words=120):
    rng = random.Random(seed)
    known = ["".join(rng.choice("abñ") for _ in range(rng.randint(4, 6))) for _ in range(words)]
    text = lambda: " ".join(rng.choice((known[: rng.randint(1, words)])) for _ in range(400))
    return [(i, text()) for i in range(6)] + [(None, text()), (3, text()), (3, None), (9, ""), (10, "ABCDE abcde Abcdé"), (11, "x" * 70_000 + " word")]


@pytest.mark.parametrize("group", [1, 20, 4096])
def test_spelling_variants(spark, monkeypatch, group):
    pairs = some_pairs(1)
    monkeypatch.setattr(spelling, "near_pairs", lambda words, f=spelling.near_pairs: f(words, group=group))
    found = [tuple(r) for r in spelling.variants(clashing(spark, pairs)).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    expected = brute_variants(pairs)
    assert len(found) == len(expected) and set(found) == expected and sum(r[1] is not None for r in expected) > 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=0, max_size=5), min_size=1, max_size=40, unique=True), st.integers(1, 7))
def test_scanning_a_sorted_list(texts, scanned):
    texts = sorted(texts)
    letters = np.array(texts, np.str_).view(np.uint32).reshape(len(texts), -1) if any(texts) else np.zeros((len(texts), 1), np.uint32)
    who, hits = spelling.one_edit(letters, (letters != 0).sum(1), np.zeros(len(texts), np.int64), np.arange(len(texts)), scanned)
    found = list(zip(who.tolist(), hits.tolist()))
    # the empty text is the root of the list, no run
    expected = {(i, j) for i in range(len(texts)) for j in range(len(texts)) if texts[j] and edit_one(texts[i], texts[j])}
    assert len(found) == len(set(found)) and set(found) == expected


def test_spelling_without_words(spark, make_docs):
    assert spelling.variants(make_docs([])).count() == 0
    assert spelling.variants(clashing(spark, [(1, "one two"), (2, None), (None, "")])).count() == 0


def test_anchors_follow_the_definition(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(n)) for n in (1, 4, 5, 6, 9, 40, 300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = {r["doc_id"]: r["anchors"] for r in syncmers.anchors(docs).collect()}
    hashed = {r["doc_id"]: r["h"] for r in docs.select("doc_id", syncmers.word_hashes(F.col("text")).alias("h")).collect()}
    # inner hashes from Spark, the choice by hand
    inner = {r["doc_id"]: r["g"] for r in docs.withColumn("h", syncmers.word_hashes(F.col("text"))).selectExpr("doc_id", "transform(sequence(0, size(h) - 2), i -> xxhash64(get(h, i), get(h, i + 1))) as g").collect() if len(hashed[r["doc_id"]]) > 1}
    for i, text in enumerate(texts):
        n = len(text.split())
        if n < syncmers.K:
            places = [0]
        else:
            places = [p for p in range(n - 4) if min(inner[i][p : p + 4]) in (inner[i][p], inner[i][p + 3])]
        assert [a["place"] for a in found[i]] == places
    # no gap of more than the window
    gaps = np.diff([a["place"] for a in found[6]])
    assert gaps.max() <= syncmers.K - syncmers.S + 1


def test_anchors_do_not_depend_on_their_surroundings(spark):
    passage = " ".join(f"w{i * i % 61}" for i in range(40))
    docs = spark.createDataFrame([(0, passage), (1, f"something else before {passage} and after")], "doc_id bigint, text string")
    both = {r["doc_id"]: r["anchors"] for r in syncmers.anchors(docs).collect()}
    inside = {(a["place"] + 3, a["hash"]) for a in both[0]}
    assert inside <= {(a["place"], a["hash"]) for a in both[1]}
    pair = syncmers.anchors(docs).groupBy().pivot("doc_id", [0, 1]).agg(F.first("anchors")).select(syncmers.shared_anchors(F.col("0"), F.col("1")).alias("m")).first()["m"]
    assert len(pair) == len(both[0]) and Counter(m["b"] - m["a"] for m in pair).most_common(1)[0][0] == 3


def test_fingerprints_against_brute_force(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["ä", "bb", "ccc", "dd\n", "e", "f\tg"]) for _ in range(n))
    pairs = [(i, text(n)) for i, n in enumerate([1, 3, 5, 12, 60, 200, 201])] + [(20, None), (21, ""), (22, " \n "), (None, text(30)), (7, "same"), (7, "same"), (7, "other words here"), (30, "x" * 50_000)]
    rows = syncmers.digests(clashing(spark, pairs)).collect()
    assert len(rows) == len(pairs)
    version = {r["text"]: r["v"] for r in spark.createDataFrame([(t or "",) for _, t in pairs], "text string").select("text", F.xxhash64("text").alias("v")).collect()}
    order = sorted({(-(2**63) if i is None else i, t or "") for i, t in pairs}, key=lambda x: (-x[0], version[x[1]]))
    after = dict(zip(order, order[1:] + order[:1]))
    texts = {t or "" for _, t in pairs}
    edited = {}
    for key in order:
        text_, n = key[1], len(key[1])
        edited[key] = text_[: n - n // 3] + after[key][1][: n // 3]
    every = sorted(texts | set(edited.values()))
    made = spark.createDataFrame([(i, t) for i, t in enumerate(every)], "doc_id bigint, text string")
    hashes = {every[r["doc_id"]]: [a["hash"] for a in r["anchors"]] for r in syncmers.anchors(made).collect()}
    least = {t: sorted(set(h))[: syncmers.SIZE] for t, h in hashes.items()}

    def like(a, b):
        union = sorted({*least[a], *least[b]})[: syncmers.SIZE]
        common = len({*union} & {*least[a]} & {*least[b]})
        return 1.0 if not union else 2 * common / (common + len(union))

    shown = lambda t: "".join(f"{v:08x}" for v in least[t])
    found = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 12), round(r["near_next"], 12)) for r in rows)
    expected = Counter()
    for i, t in pairs:
        key = (-(2**63) if i is None else i, t or "")
        e, nxt = edited[key], after[key][1]
        expected[(i, len(key[1]), hashlib.sha256(e.encode()).hexdigest(), shown(key[1]), shown(e), round(like(key[1], e), 12), round(like(key[1], nxt), 12))] += 1
    assert found == expected


def test_fingerprints_of_one_document_and_of_none(spark, make_docs):
    row = syncmers.digests(make_docs([(4, "abc def")])).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest()
    assert syncmers.digests(make_docs([])).count() == 0


def test_edited_texts_are_alike_and_neighbours_are_not(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = syncmers.digests(docs).collect()
    words = {r["doc_id"]: len(r["text"].split()) for r in docs.collect()}
    long = [r for r in rows if words[r["doc_id"]] >= 60]
    assert np.median([r["near_edited"] for r in long]) > 0.6 and np.mean([r["near_edited"] > 0.3 for r in long]) > 0.97
    assert np.mean([r["near_next"] < 0.2 for r in long]) > 0.95


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


@pytest.fixture(scope="module")
def known():
    return alignment.Vocabularies()


def byte_letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


def test_alignment_against_brute_force(spark, tokenizer, known):
    texts = [None, "", "a", "Ein längerer Satz, mit Wörtern.", "日本語 und mehr \U0001f600", "a<|endoftext|>b <s> </s>", "two  blanks\n\n", "a▁b", " lead", "word " * 3000, "naïve x", "İstanbul ﬁ"]
    pairs = list(enumerate(texts)) + [(None, "A word."), (3, "A word."), (3, "A word.")]
    letters = byte_letters()
    counts, expected = Counter(), []
    for doc, text in pairs:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = known.pieces.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
        piece = [known.pieces.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in piece]
        data = b" " + (text or "").encode()
        if not text or b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            expected.append((doc, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        both, i, j, shown = sorted({*ends_a} & {*ends_b}), 0, 0, []
        for end in both:
            p, q = ends_a.index(end) + 1, ends_b.index(end) + 1
            shown.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        linked = [(a[ends_a.index(e)], b[ends_b.index(e)]) for e in both]
        counts.update(linked)
        expected.append((doc, len(a), len(b), len(both), linked, hashlib.sha256(";".join(shown).encode()).hexdigest()))
    most = Counter()
    for (a, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = Counter((d, a, b, g, len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), sha) for d, a, b, g, x, sha in expected)
    found = Counter(tuple(r) for r in alignment.digests(clashing(spark, pairs)).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())
    assert found == rows and sum(r[1] > 0 for r in rows) > 5 and sum(r[1] == 0 for r in rows) >= 3
    table_ = {(r["a"], r["b"]): (r["n"], r["best"]) for r in alignment.pair_counts(clashing(spark, pairs)).collect()}
    assert table_ == {p: (n, n == most[p[1]]) for p, n in counts.items()}


def test_alignment_of_nothing(make_docs):
    assert alignment.digests(make_docs([])).count() == 0


def test_linked_pairs_follow_from_the_vocabularies(known):
    made = {(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in known.pairs[:: len(known.pairs) // 500]}
    for a, b in made:
        x, y = known.a.entries[a], known.b.entries[b]
        assert x.endswith(y) or y.endswith(x)
    assert len(known.pairs) < 10 * (len(known.a.entries) + len(known.b.entries))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.lists(st.integers(1, 4), min_size=1, max_size=12))
def test_coalescing_intervals(first, second):
    total = max(sum(first), sum(second))
    first, second = first + [1] * (total - sum(first)), second + [1] * (total - sum(second))
    token, side, group, starts, ends = alignment.coalesce(np.array(first), np.array(second))
    common = sorted({*np.cumsum(first).tolist()} & {*np.cumsum(second).tolist()})
    assert group.tolist() == np.searchsorted(common, ends).tolist()
    assert [(s, t) for s, t in zip(side.tolist(), token.tolist())] == sorted(zip(side.tolist(), token.tolist()), key=lambda x: (int(np.searchsorted(common, (np.cumsum(first), np.cumsum(second))[x[0]][x[1]])), x))
    a, b = np.cumsum(first), np.cumsum(second)
    assert {*zip(*(x.tolist() for x in alignment.links(token, side, ends)))} == {(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] == b[j]}
    shared = {*zip(*(x.tolist() for x in alignment.overlaps(token, side, starts, ends)))}
    assert shared == {(i, j) for i in range(len(a)) for j in range(len(b)) if min(a[i], b[j]) > max(a[i] - first[i], b[j] - second[j])}


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "<|endoftext|>", "plain", "日本<|endoftext|>", "tail <|endoftext|"])
def test_packing_takes_ids_as_the_plain_call_gives_them(make_docs, text):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = sorted(packing.pack(make_docs([(1, text)])).collect(), key=lambda r: r["start"])
    assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in pieces]).tolist() == [*plain.encode(text, add_special_tokens=False).ids, packing.END]


def test_combinations_of_forms_end_in_one_root(spark):
    """A chain of forms longer than one doubling round."""
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(3 * 2**i))
    rows = {r["word"]: r for r in spelling.variants(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), slip=None).collect()}
    assert {r["root"] for r in rows.values()} == {"bbbbb"} and rows["aaaaa"]["form"] == "aaaab"
    assert sum(edit_one(a, b) for a, b in combinations(chain, 2)) == 5
