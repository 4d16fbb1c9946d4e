"""CSV records read in blocks give what the reader of whole files gives."""

import bz2
import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import feeds
from ledgerloom.plans.registry import QUERIES
from ledgerloom.sources.records import lines_of, records_of, states_before
from ledgerloom.sources.workspace import shared_dir

SCHEMA = "id int, note string, amount decimal(12,2)"


@pytest.fixture
def small_blocks(spark):
    """Blocks of a hundred bytes or so."""
    keys = {"spark.sql.files.maxPartitionBytes": "120b", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def texts(df):
    return sorted(tuple("" if v is None else f"={v}" for v in r) for r in df.select("id", "note", "amount").collect())


def both(spark, path, separator=","):
    whole, wanted, names = feeds.feed_texts(spark, path, SCHEMA, separator)
    blocks, _, _ = feeds.feed_texts(spark, path, SCHEMA, separator, in_blocks=True)
    return whole, blocks


def note(draw):
    """A value of any kind, also badly quoted ones."""
    kind = draw.randrange(9)
    words = [draw.choice(["a", "été", "x y", "5", ";", "'"]) for _ in range(draw.randrange(1, 5))]
    return {
        0: "", 1: '""', 2: " ".join(words), 3: '"' + "\n".join(words) + '"', 4: '"' + ",".join(words) + '"', 5: '"say ""' + "\n".join(words) + '"""',
        6: '5" ' + words[0], 7: '"\n\n' + words[0] + '"', 8: '"' + "\n,1,2\n".join(words * 8) + '"',
    }[kind]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_blocks_give_the_rows_of_whole_files(spark, small_blocks, tmp_path, seed, end):
    draw = random.Random(seed)
    for part in range(2):
        rows = [f"{i},{note(draw)},{draw.randrange(900) / 100}" for i in range(60)]
        (tmp_path / f"part{part}.csv").write_bytes(("id,note,amount\n" + "\n".join(rows) + ("\n" if part else "")).replace("\n", end).encode())
    whole, blocks = both(spark, str(tmp_path))
    assert blocks.count() == 120
    assert texts(blocks) == texts(whole)
    assert lines_of(spark, str(tmp_path)).select("_file", "_block").distinct().count() > 20


def test_faults_are_those_of_whole_files(spark, small_blocks, tmp_path):
    """Values that do not parse, rows too short and too long, empty lines, a last quote that is not closed."""
    rows = ["1,a,1.5", "x,b,2", "3,c", "", "4,d,1,9", '5,"e\nf",z', "6,,", '7,"g\n' + "h\n" * 200 + 'i",3', '8,"open', "9,j,1"]
    (tmp_path / "f.csv").write_text("\nid,note,amount\n" + "\n".join(rows) + "\n")
    for good_or_bad in (0, 1):
        whole, blocks = (feeds.read_feed(spark, str(tmp_path), SCHEMA, in_blocks=b)[good_or_bad] for b in (False, True))
        shown = whole.columns if good_or_bad == 0 else ["faults"]
        assert sorted(map(str, blocks.select(shown).collect())) == sorted(map(str, whole.select(shown).collect()))


def test_a_feed_in_blocks_counts_its_rejects(spark, small_blocks, tmp_path):
    (tmp_path / "f.csv").write_text("amount|id|note\n" + "".join(f'{i}.5|{i if i % 10 else "x"}|"n\n|{i}"\n' for i in range(100)))
    feed = feeds.load_feed(spark, str(tmp_path), SCHEMA, "|", max_share=0.2, in_blocks=True)
    assert (feed.counts["rows"], feed.counts["rejected"], feed.counts["column id"]) == (100, 10, 10)
    assert {r["note"] for r in feed.rows.collect()} == {f"n\n|{i}" for i in range(100) if i % 10}


def test_a_header_alone_and_another_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note,amount\n")
    assert both(spark, str(tmp_path))[1].count() == 0
    (tmp_path / "b.csv").write_text("note,id,amount\na,1,2\n")
    with pytest.raises(Exception, match="another header"):
        both(spark, str(tmp_path))[1].collect()


def test_a_value_over_many_blocks_is_one_record(spark, small_blocks, tmp_path):
    (tmp_path / "f.csv").write_text("id,note,amount\n" + '1,"' + "x\n" * 500 + '",1\n' + "2,b,2\n")
    records = records_of(lines_of(spark, str(tmp_path)), ",").where("not _header")
    assert sorted(r[0] for r in records.select(F.length("_record")).collect()) == [5, 1006]


def test_states_before_lines_are_a_fold():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50):
        for inside in (False, True):
            to_0, to_1 = rng.random(n) < 0.4, rng.random(n) < 0.6
            state, want = inside, []
            for a, b in zip(to_0, to_1):
                want.append(state)
                state = bool(b if state else a)
            assert states_before(to_0, to_1, inside).tolist() == want


def test_a_packed_file_is_read_in_blocks_too(spark, tmp_path):
    draw = random.Random(9)
    rows = "".join(f'{i},"{draw.getrandbits(400):x}\n""{draw.getrandbits(400):x}""",{i}.25\n' for i in range(14_000))
    (tmp_path / "f.csv.bz2").write_bytes(bz2.compress(("id,note,amount\n" + rows).encode(), 1))
    keys = {"spark.sql.files.maxPartitionBytes": "300k", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        assert lines_of(spark, str(tmp_path)).select("_block").distinct().count() > 3
        whole, blocks = both(spark, str(tmp_path))
        assert texts(whole) == texts(blocks)
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_lines_of_a_feed_in_blocks_are_not_shuffled_and_its_files_are_packed(spark):
    folder = pathlib.Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    assert QUERIES["src_statements_in_blocks"](spark, "/root/testdata/sf0.001").count() > 20_000
    new = {f.name.rsplit("-", 1)[0] for f in set(folder.iterdir()) - before}
    assert "csv-lines" not in new and "csv-records" in new
    assert [f for d in set(folder.iterdir()) - before for f in d.glob("part-*.csv.bz2")] and not [f for d in set(folder.iterdir()) - before for f in d.glob("part-*.csv")]
