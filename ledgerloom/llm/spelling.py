"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

A word is a maximal run of Latin letters, A-Z lower-cased, of at least ``MIN_CHARS`` code points and ``MIN_COUNT``
occurrences. Two words are near if one inserted, deleted or replaced code point tells them apart. The form of a word is
its most frequent near word, if that is at least twice as frequent; following forms to the end gives its root.

Words that are near agree outside a short window around the edit. Each word is therefore dealt to one group per window
and role (the shorter or equally long word of a pair, or the longer one), keyed by the letters outside the window. In a
group the windows stand in a sorted list. All words of the shorter role scan it together: a row of the banded edit
matrix belongs to a run of the list with a common prefix, is computed once for the whole run and handed on to the runs
inside it, and a run whose common prefix already exceeds one edit is skipped with all its words.

Groups of more than ``GROUP`` words are dealt again by halved windows, down to windows of one letter, whose groups are
bounded by the alphabet alone. An insertion fits two neighbouring windows; only the window that holds the first place
where the words differ reports it, so no pair is reported twice. A chain of forms at least doubles the count at every
hop, so the roots are found in a number of pointer-doubling rounds that the largest count bounds; each is written.

Cases: a null or empty text has no words; a null doc_id is the empty text where the id is written; repeated rows count
each time; ties between forms go to the smaller word in code-point order; texts of any length are read whole; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.tables import written

LETTERS = "[A-Za-zÀ-ÿ]"
MIN_CHARS = 5
MIN_COUNT = 3
#: One of so many (document, run) hashes loses a letter.
SLIP = 97
#: A form is at least so many times as frequent.
FACTOR = 2
#: Widths of the windows, from the first dealing to the last.
WIDTHS = (4, 2, 1)
#: Words in a group before it is dealt again.
GROUP = 4096
#: Words that scan a list together.
SCANNED = 16_384
#: Different words a task counts before it hands them on.
HELD = 200_000
FAR = 2


def slipped(doc: bytes, run: str) -> str:
    """The run as it counts in the document ``doc``: one of 97 loses a letter."""
    from zlib import crc32

    h = crc32(run.encode(), crc32(doc + b":"))
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, slip: Callable[[bytes, str], str] | None = slipped) -> DataFrame:
    """(word, n) of all words of at least ``MIN_CHARS`` letters; counted in the task before they are shuffled."""
    def run(batches: Iterator) -> Iterator:
        import re

        import pyarrow as pa

        runs = re.compile(f"{LETTERS}{{{MIN_CHARS},}}").findall
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None:
                    continue
                found = Counter(runs(text.lower().decode()))
                if slip is None:
                    counts.update(found)
                else:
                    for word, n in found.items():
                        counts[slip(doc, word)] += n
                if len(counts) >= HELD:
                    yield flush()
        yield flush()

    # lower() of bytes touches A-Z alone
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary").alias("doc"), F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(run, "word string, n bigint").where(F.char_length("word") >= MIN_CHARS)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, min_count: int = MIN_COUNT, slip: Callable[[bytes, str], str] | None = slipped) -> DataFrame:
    return word_counts(docs, slip).where(F.col("n") >= min_count)


def dealt(words: DataFrame, width: int = WIDTHS[0]) -> DataFrame:
    """Rows (key, word, n, shorter, low, high, last) of each word, by role and window: ``low`` and ``high`` bound the window of the shorter role."""
    roles = F.explode(F.array(F.lit(True), F.lit(False)))
    rows = words.select("word", "n", roles.alias("shorter")).withColumn("m", F.char_length("word") - F.when(F.col("shorter"), 0).otherwise(1)).where("m > 0")
    rows = rows.withColumn("windows", F.ceil(F.col("m") / width).cast("int")).withColumn("w", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)))
    rows = rows.withColumns({"low": F.expr("cast(m * w div windows as int)"), "high": F.expr("cast(m * (w + 1) div windows as int)"), "last": F.expr("w + 1 = windows")})
    return _keyed(rows.withColumn("of", F.col("m").cast("string")))


def narrowed(rows: DataFrame, width: int) -> DataFrame:
    """The rows dealt again by windows of at most ``width`` letters inside their windows."""
    rows = rows.withColumn("parts", F.ceil((F.col("high") - F.col("low")) / width).cast("int")).withColumn("w", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    inside = rows.withColumns({
        "first": F.expr("cast(low + (high - low) * w div parts as int)"), "until": F.expr("cast(low + (high - low) * (w + 1) div parts as int)"), "last": F.expr("last and w + 1 = parts")})
    kept = inside.select("word", "n", "shorter", "last", F.col("first").alias("low"), F.col("until").alias("high"), F.split_part("key", F.lit(":"), F.lit(1)).alias("of"))
    return _keyed(kept)


def _keyed(rows: DataFrame) -> DataFrame:
    """The key is the length of the shorter role and the letters before and after the window."""
    after = F.expr("substring(word, high + if(shorter, 1, 2))")
    key = F.concat("of", F.lit(":"), F.expr("left(word, low)"), F.lit("*"), after)
    return rows.select(key.alias("key"), "word", "n", "shorter", "low", "high", "last")


def grouped_rows(words: DataFrame, widths: tuple[int, ...] = WIDTHS, group: int = GROUP) -> DataFrame:
    """All rows in groups of at most ``group`` words, or of the narrowest window."""
    rows, settled = dealt(words, widths[0]), None
    for width in widths[1:]:
        hot = rows.groupBy("key").agg(F.count("*").alias("words")).where(F.col("words") > group).select("key")
        cool = rows.join(hot, "key", "left_anti")
        settled = cool if settled is None else settled.unionByName(cool)
        rows = narrowed(rows.join(hot, "key", "left_semi"), width)
    return rows if settled is None else settled.unionByName(rows)


def one_edit(letters: np.ndarray, lengths: np.ndarray, groups: np.ndarray, asking: np.ndarray, scanned: int = SCANNED) -> tuple[np.ndarray, np.ndarray]:
    """(asking row, found row) of all pairs of one group that are exactly one edit apart.

    ``letters`` holds a text per row, padded with zeros, rows sorted by group and text. ``asking`` are the rows that scan
    the list of their group. A state is a scanning row, a run [low, high) of the list with a common prefix, and the band
    of the edit matrix for that prefix: the distances to the scanning text cut one letter shorter, equally long and one
    letter longer than the prefix.
    """
    rows, depth = letters.shape
    new = np.ones(rows, bool)
    new[1:] = groups[1:] != groups[:-1]
    bounds = np.append(np.flatnonzero(new), rows)
    of = np.searchsorted(bounds, np.arange(rows), "right") - 1
    # Runs of rows that share the first d + 1 letters: adjacent rows whose common prefix is longer than d.
    runs = []
    for d in range(depth):
        new[1:] |= letters[1:, d] != letters[:-1, d]
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], rows)
        whole = letters[starts, d] != 0
        runs.append((starts[whole], ends[whole]))
    padded = np.zeros((rows, depth + 2), letters.dtype)
    padded[:, :depth] = letters
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at in range(0, len(asking), scanned):
        who = asking[at : at + scanned]
        low, high = bounds[of[who]], bounds[of[who] + 1]
        short, even, long = np.full(len(who), FAR, np.int8), np.zeros(len(who), np.int8), np.ones(len(who), np.int8)
        for d in range(depth):
            starts, ends = runs[d]
            first, until = np.searchsorted(starts, low), np.searchsorted(starts, high)
            count = until - first
            state = np.repeat(np.arange(len(who)), count)
            if not len(state):
                break
            child = np.arange(len(state)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
            who, low, high = who[state], starts[child], ends[child]
            letter, size, text = letters[low, d], lengths[who], padded[who]
            before = np.where(d >= 1, text[:, max(d - 1, 0)] != letter, True)
            a = np.minimum(even[state] + 1, short[state] + before)
            b = np.minimum(np.minimum(even[state] + (text[:, d] != letter), long[state] + 1), a + 1)
            c = np.minimum(long[state] + (text[:, d + 1] != letter), b + 1)
            short = np.where(size >= d, a, FAR).astype(np.int8)
            even = np.where(size >= d + 1, b, FAR).astype(np.int8)
            long = np.where(size >= d + 2, c, FAR).astype(np.int8)
            distance = np.select([size == d, size == d + 1, size == d + 2], [short, even, long], FAR)
            hit = (lengths[low] == d + 1) & (distance == 1)
            found.append((who[hit], low[hit]))
            alive = np.minimum(np.minimum(short, even), long) <= 1
            who, low, high, short, even, long = (x[alive] for x in (who, low, high, short, even, long))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def near_pairs(words: DataFrame, widths: tuple[int, ...] = WIDTHS, group: int = GROUP) -> DataFrame:
    """(word, n, other, other_n): each pair of near words once."""
    rows = grouped_rows(words, widths, group)
    window = F.expr("substring(word, low + 1, high - low + if(shorter, 0, 1))")
    lists = rows.select("key", window.alias("text"), "word", "n", "shorter", "last").repartition("key").sortWithinPartitions("key", "text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        def pairs(rows: pa.Table) -> pa.RecordBatch:
            keys = rows.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
            texts = rows.column("text").to_pylist()
            shorter, last = (rows.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("shorter", "last"))
            wide = np.array(texts, dtype=np.str_)
            letters = np.ascontiguousarray(wide).view(np.uint32).reshape(len(texts), -1)
            lengths = (letters != 0).sum(1)
            who, hits = one_edit(letters, lengths, keys, np.flatnonzero(shorter))
            # Of two words of one length, both scan; an insertion at the end of a window is the next window's.
            ends_alike = (letters[who] == np.where(np.arange(letters.shape[1]) < lengths[who][:, None], letters[hits], 0)).all(1)
            keep = np.where(shorter[hits], who < hits, last[who] | ~ends_alike)
            who, hits = pa.array(who[keep]), pa.array(hits[keep])
            word, n = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
            return pa.RecordBatch.from_arrays([word.take(who), n.take(who), word.take(hits), n.take(hits)], ["word", "n", "other", "other_n"])

        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if not len(rows):
                continue
            keys = rows.column("key").combine_chunks()
            earlier = np.flatnonzero(pc.not_equal(keys, keys[-1]).to_numpy(zero_copy_only=False))
            whole = int(earlier[-1]) + 1 if len(earlier) else 0
            held = rows.slice(whole)
            if whole:
                yield pairs(rows.slice(0, whole))
        if held is not None and len(held):
            yield pairs(held)

    return lists.mapInArrow(run, "word string, n bigint, other string, other_n bigint")


def forms(words: DataFrame, pairs: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word."""
    back = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    # The least (-count, word) is the most frequent near word, ties by code point.
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    near = pairs.unionByName(back).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.select("word", "n").join(near, "word", "left")
    enough = -F.col("best.less") >= factor * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by pointer doubling."""
    links = written(formed.where("form is not null").select("word", F.col("form").alias("root")), "spelling-forms")
    most = formed.agg(F.max("form_n")).first()[0] or 1
    # A chain of h hops multiplies the count by 2^h at least.
    hops = int(most).bit_length()
    for _ in range(hops.bit_length()):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        links = written(links.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "spelling-roots")
    return links


def variants(docs: DataFrame, min_count: int = MIN_COUNT, slip: Callable[[bytes, str], str] | None = slipped) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary of ``docs``.

    ``slip=None`` counts the runs as they stand.
    """
    words = written(vocabulary(docs, min_count, slip), "spelling-words")
    formed = written(forms(words, near_pairs(words)), "spelling-near")
    found = formed.join(roots(formed), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The remainders of the reflected polynomial 0xEDB88320, one per byte value, by their rule.
_STEP = "list_transform({}, lambda x: if(x & 1 = 1, xor(x >> 1, 3988292384), x >> 1))"


def _table() -> str:
    made = "range(256)"
    for _ in range(8):
        made = _STEP.format(made)
    return made


ORACLE = f"""with recursive crc as (select {_table()} as t),
runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents),
counted as (select doc_id, run, count(*) as c from runs where length(run) >= {MIN_CHARS} group by all),
named as (select run, c, hex(coalesce(cast(doc_id as varchar), '') || ':' || run) as h from counted),
hashed as (select run, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: cast('0x' || substr(h, cast(2 * i + 1 as int), 2) as bigint))),
  lambda s, b: xor(s >> 8, t[cast(xor(s, b) & 255 as int) + 1])), 4294967295) as v from named, crc),
written as (select if(v % {SLIP} = 0, substr(run, 1, cast(v % length(run) as int)) || substr(run, cast(v % length(run) as int) + 2), run) as word, c from hashed),
words as materialized (select word, cast(sum(c) as bigint) as n from written where length(word) >= {MIN_CHARS} group by word having sum(c) >= {MIN_COUNT}),
less as materialized (select word, n, p, substr(word, 1, cast(p as int) - 1) || substr(word, cast(p as int) + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as p from words)),
pairs as (select a.word, a.n, b.word as other, b.n as other_n from less a join less b on a.rest = b.rest and a.p = b.p and a.word <> b.word
  union select w.word, w.n, l.word, l.n from words w join less l on w.word = l.rest union select l.word, l.n, w.word, w.n from words w join less l on w.word = l.rest),
best as (select word, count(*) as n_near, min((-other_n, other)) as b from pairs group by word),
formed as materialized (select w.word, w.n, coalesce(n_near, 0) as n_near, if(-b[1] >= {FACTOR} * w.n, b[2], null) as form, if(-b[1] >= {FACTOR} * w.n, -b[1], null) as form_n
  from words w left join best on best.word = w.word),
chain as (select word, word as at from formed union all select c.word, f.form from chain c join formed f on f.word = c.at where f.form is not null),
ends as (select c.word, c.at as root from chain c join formed f on f.word = c.at where f.form is null)
select f.word, f.form, e.root, f.n, cast(f.n_near as bigint) as n_near, cast(f.form_n as bigint) as form_n from formed f join ends e on e.word = f.word"""
