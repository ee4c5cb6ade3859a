"""Parts of the signature table: merging in tiers, replays and unfinished writes."""

import pytest

from fixtures import day, edge_facts, fact, facts, rows
from rankdrift.operators import minhash
from rankdrift.sources import csv_report
from rankdrift.sources import signature_table as table
from rankdrift.streaming.signatures import maintain_signatures

K = 8
SETTINGS = table.signature_settings(K)


def batch(spark, n):
    return facts(spark, [fact(d, m, url=f"u{n % 7}{x}") for d in ("desktop", "smartphone") for m in (1, 2) for x in range(3)])


def append(spark, path, n, fan=4):
    table.append_batch(minhash.minhash_signatures(batch(spark, n), K), path, "s", n, K, SETTINGS, fan)


def read(spark, path):
    return sorted(rows(table.read_signatures(spark, path, K)))


def test_fifty_batches_leave_a_few_files(spark, tmp_path):
    path = str(tmp_path / "sig")
    for n in range(50):
        append(spark, path, n)
    parts = table.committed_parts(spark, path)
    live = sorted(table.live_parts(parts), key=lambda p: p.first)
    assert [(p.first, p.last) for p in live] == [(0, 15), (16, 31), (32, 47), (48, 48), (49, 49)]
    files = list((tmp_path / "sig").glob("part=*/crawl_date=2017-07-01/*.parquet"))
    assert len(files) <= 13  # with those that are to be removed at the next merge
    every = batch(spark, 0)
    for n in range(1, 7):
        every = every.unionByName(batch(spark, n))
    whole = sorted(rows(minhash.minhash_signatures(every, K)))
    assert read(spark, path) == whole
    # Replays of merged batches, and of one that stands alone, change nothing.
    for n in (3, 20, 49):
        append(spark, path, n)
    assert table.committed_parts(spark, path) == parts and read(spark, path) == whole


def test_an_unfinished_merge_is_not_read(spark, tmp_path):
    path = str(tmp_path / "sig")
    for n in range(3):
        append(spark, path, n)
    before = read(spark, path)
    lost = tmp_path / "sig" / f"part={table.Part.of_stream('s', 0, 2).name}"
    table.write_signature_part(minhash.minhash_signatures(batch(spark, 0), K), path, lost.name.removeprefix("part="), SETTINGS)
    (lost / "_SUCCESS").unlink()
    assert read(spark, path) == before
    append(spark, path, 3)  # merges, over the parts of the lost merge as well
    assert [(p.first, p.last) for p in table.live_parts(table.committed_parts(spark, path))] == [(0, 3)]


def test_streams_and_named_parts_stay_apart(spark, tmp_path):
    path = str(tmp_path / "sig")
    for n in range(5):
        append(spark, path, n, fan=2)
    table.append_batch(minhash.minhash_signatures(batch(spark, 6), K), path, "t", 0, K, SETTINGS)
    table.write_signature_part(minhash.minhash_signatures(batch(spark, 5), K), path, "late", SETTINGS)
    live = {(p.stream, p.first, p.last) for p in table.live_parts(table.committed_parts(spark, path))}
    assert live == {("s", 0, 3), ("s", 4, 4), ("t", 0, 0), (None, None, None)}
    every = batch(spark, 0)
    for n in range(1, 7):
        every = every.unionByName(batch(spark, n))
    assert read(spark, path) == sorted(rows(minhash.minhash_signatures(every, K)))


def test_tiers():
    part = lambda a, b: table.Part.of_stream("s", a, b)
    assert [part(0, n).tier(4) for n in (0, 2, 3, 14, 15, 63)] == [0, 0, 1, 1, 2, 3]
    assert table.Part.of(part(3, 9).name) == part(3, 9) and table.Part.of("am") == table.Part("am")
    assert part(0, 3).holds(part(1, 3)) and not part(0, 3).holds(part(3, 4)) and not table.Part("a").holds(table.Part("a"))


def test_names_of_parts(spark, tmp_path):
    with pytest.raises(ValueError):
        table.write_signature_part(minhash.minhash_signatures(edge_facts(spark), K), str(tmp_path), "a/b")


def test_no_parts(spark, tmp_path):
    assert read(spark, str(tmp_path / "none")) == []


def test_a_replayed_micro_batch(spark, tmp_path):
    """The checkpoint forgets that the last batch was done; the stream runs it again after its part was merged."""
    path, folder, checkpoint = str(tmp_path / "sig"), tmp_path / "reports", tmp_path / "checkpoint"
    folder.mkdir()

    def run():
        stream = csv_report.stream_rank_csv(spark, str(folder), files_per_batch=1)
        maintain_signatures(stream, path, str(checkpoint), "r", k=K, once=True, fan=2).awaitTermination()

    for n in (1, 2):
        (folder / f"{n}.csv").write_text(f"k,m,l,d,c,r,u\na,US,,desktop,2017-07-0{n},1,u{n}\n")
        run()
    parts = table.committed_parts(spark, path)
    assert [(p.first, p.last) for p in table.live_parts(parts)] == [(0, 1)]
    before = read(spark, path)
    for name in ("1", ".1.crc"):
        (checkpoint / "commits" / name).unlink()
    run()
    assert table.committed_parts(spark, path) == parts and read(spark, path) == before
    assert [r[0] for r in before] == [day(1), day(2)]
