import gzip

import pytest
from pyspark.sql import functions as F

from fixtures import day, edge_facts, fact, facts, rows
from rankdrift.functions.text import day_text, dot_bar
from rankdrift.operators import cleaning, minhash
from rankdrift.plans import report
from rankdrift.plans.views import rank_facts
from rankdrift.schema import RANK_SCHEMA
from rankdrift.session import scratch_dir, tune
from rankdrift.sources import csv_report, rank_table, signature_table
from rankdrift.streaming.signatures import maintain_signatures

HEADER = "Keyword,Market,Location,Device,Crawl Date,Rank,URL\n"


def csv_file(tmp_path, text, name="report.csv"):
    path = tmp_path / name
    path.write_text(HEADER + text)
    return str(path)


def test_csv_report(spark, tmp_path):
    path = csv_file(
        tmp_path,
        "a,US-en,,desktop,2017-07-01, 3, u1 \n"
        '"b, ""c""",US-en,"",smartphone,2017-07-02,1,"u,2"\n'
        "d,US-en,Berlin,desktop,2017-07-03,100,u3\n",
    )
    assert rows(csv_report.read_rank_csv(spark, path)) == [
        ("a", "US-en", None, "desktop", day(1), 3, "u1"),
        ('b, "c"', "US-en", None, "smartphone", day(2), 1, "u,2"),
        ("d", "US-en", "Berlin", "desktop", day(3), 100, "u3"),
    ]


BAD_LINES = [
    "a,US,,desktop,yesterday,1,u2",
    "a,US,,desktop,2017-07-01,1st,u3",
    "a,US,,desktop,2017-07-01,1",
    ",US,,desktop,2017-07-01,1,u5",
    "a,US,,desktop,2017,1,u6",
    "a,US,,desktop,2017-7-1,1,u7",
    "a,US,,desktop,2017-02-30,1,u8",
    "a,US,,desktop,2017-07-01 10:00,1,u9",
    "a,US,,desktop,2017-07-01,0,u10",
    "a,US,,desktop,2017-07-01,-1,u11",
    "a,US,,desktop,2017-07-01,1,http://x/a,b",
    "a,US,,desktop,2017-07-01,1,u12,",
    'b",US,,desktop,2017-07-01,1,u13',
]


@pytest.mark.parametrize("line", BAD_LINES)
def test_a_bad_row_stops_the_read_whatever_is_selected(spark, tmp_path, line):
    path = csv_file(tmp_path, f"a,US,,desktop,2017-07-01,1,u1\n{line}\n")
    for columns in (["url"], ["rank"], ["loc"]):
        with pytest.raises(Exception, match="bad row in rank report"):
            csv_report.read_rank_csv(spark, path).select(*columns).collect()


def test_bad_rows_are_kept_apart(spark, tmp_path):
    path = csv_file(tmp_path, "\n".join(["a,US,,desktop,2017-07-01,1,u1", *BAD_LINES]) + "\n")
    kept = csv_report.read_rank_csv(spark, path, on_bad="keep")
    assert rows(csv_report.good_rows(kept), "url") == [("u1",)]
    assert csv_report.good_rows(kept).columns == RANK_SCHEMA.names
    texts = [t for (t,) in rows(csv_report.bad_rows(kept), "_bad_row")]
    assert texts[0] == "a,US,,desktop,yesterday,1,u2"
    assert len(texts) == len(BAD_LINES)
    with pytest.raises(ValueError):
        csv_report.read_rank_csv(spark, path, on_bad="ignore")


def test_gzip_and_many_files(spark, tmp_path):
    (tmp_path / "1.csv.gz").write_bytes(
        gzip.compress((HEADER + "a,US,,desktop,2017-07-01,1,u1\n").encode())
    )
    csv_file(tmp_path, "a,US,,desktop,2017-07-02,1,u1\n", "2.csv")
    assert csv_report.read_rank_csv(spark, str(tmp_path)).count() == 2


def test_table_is_partitioned_replaced_and_pruned(spark, tmp_path):
    path = str(tmp_path / "ranks")
    rank_table.write_rank_table(cleaning.clean_ranks(facts(spark, [fact(n=9)])), path)
    rank_table.write_rank_table(cleaning.clean_ranks(edge_facts(spark)), path)
    table = rank_table.read_rank_table(spark, path)
    assert sorted(rows(table)) == sorted(rows(cleaning.clean_ranks(edge_facts(spark))))
    assert sorted(p.name for p in (tmp_path / "ranks").glob("crawl_date=*")) == [
        f"crawl_date=2017-07-0{n}" for n in (1, 2, 3, 4)
    ]
    part = rank_table.read_rank_table(spark, path, day(2), day(3))
    assert {d.day for (d,) in rows(part, "crawl_date")} == {2, 3}
    assert len(part.inputFiles()) == 4  # inputFiles ignores the filter
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(crawl_date" in plan


def test_upsert_inserts_replaces_and_leaves_other_days_alone(spark, tmp_path):
    path = str(tmp_path / "ranks")
    rank_table.upsert_rank_table(facts(spark, [fact(n=1, url="a"), fact(n=2, url="z")]), path)
    untouched = next((tmp_path / "ranks" / "crawl_date=2017-07-02").glob("*.parquet"))
    rank_table.upsert_rank_table(
        facts(spark, [fact(n=1, url="A"), fact(n=1, rank=2, url="c"), fact(n=3, url="d", loc="")]),
        path,
    )
    table = rank_table.read_rank_table(spark, path)
    assert sorted(rows(table, "crawl_date", "rank", "loc", "url")) == [
        (day(1), 1, "", "A"),
        (day(1), 2, "", "c"),
        (day(2), 1, "", "z"),
        (day(3), 1, "", "d"),
    ]
    assert untouched.exists()


def test_upsert_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "ranks")
    for _ in range(2):
        rank_table.upsert_rank_table(edge_facts(spark), path)
    table = rank_table.read_rank_table(spark, path)
    assert sorted(rows(table)) == sorted(rows(cleaning.clean_ranks(edge_facts(spark), latest=True)))


def test_upsert_of_a_source_that_changes(spark, tmp_path):
    """What is read twice is what was staged, so no date loses rows that were not read."""
    path = str(tmp_path / "ranks")
    rank_table.upsert_rank_table(edge_facts(spark), path)
    shaky = edge_facts(spark).where(F.rand() < 0.5).withColumn("url", F.concat("url", F.lit("!")))
    for _ in range(3):
        rank_table.upsert_rank_table(shaky, path)
        table = rank_table.read_rank_table(spark, path)
        assert table.count() == 11 and table.where("crawl_date = DATE '2017-07-01'").count() > 3
    rank_table.upsert_rank_table(edge_facts(spark).where("false"), path)
    assert rank_table.read_rank_table(spark, path).count() == 11


def test_upsert_of_some_dates(spark, tmp_path):
    path = str(tmp_path / "ranks")
    rank_table.upsert_rank_table(edge_facts(spark), path)
    rank_table.upsert_rank_table(facts(spark, [fact(n=1, url="n"), fact(n=2, url="n")]), path)
    table = rank_table.read_rank_table(spark, path)
    new = rows(table.where("url = 'n'"), "crawl_date", "device", "rank")
    assert sorted(new) == [(day(1), "desktop", 1), (day(2), "desktop", 1)]
    assert table.count() == 11


def test_source_is_named_explicitly(spark, tmp_path):
    path = csv_file(tmp_path, "a,US,,desktop,2017-07-01,1,u1\n")
    assert rank_table.load_ranks(spark, csv=path).count() == 1
    for wrong in ({}, {"csv": path, "table": path}):
        with pytest.raises(ValueError):
            rank_table.load_ranks(spark, **wrong)


def test_signature_table_parts(spark, tmp_path):
    path, compacted = str(tmp_path / "sig"), str(tmp_path / "sig2")
    df = edge_facts(spark)
    halves = [df.where("rank = 1"), df.where("rank > 1")]
    for part, half in zip("abb", [*halves, halves[1]]):
        signature_table.write_signature_part(minhash.minhash_signatures(half), path, part)
    whole = sorted(rows(minhash.minhash_signatures(df)))
    assert sorted(rows(signature_table.read_signatures(spark, path))) == whole
    signature_table.compact_signatures(spark, path, compacted)
    assert sorted(rows(signature_table.read_signatures(spark, compacted))) == whole
    first = signature_table.read_signatures(spark, path, start=day(1), end=day(1))
    assert first.count() == 2


def test_stream_of_report_files_equals_batch(spark, tmp_path):
    folder = tmp_path / "reports"
    folder.mkdir()
    path, checkpoint = str(tmp_path / "sig"), str(tmp_path / "checkpoint")

    def run():
        stream = csv_report.stream_rank_csv(spark, str(folder), files_per_batch=1)
        query = maintain_signatures(stream, path, checkpoint, "reports", k=16, once=True)
        query.awaitTermination()

    def lines(devices, days):
        return "".join(
            f"k{i},US,,{d},2017-07-0{n},{i},u{i * n % 5}\n"
            for d in devices
            for n in days
            for i in range(1, 6)
        )

    csv_file(folder, lines(["desktop"], [1, 2]), "1.csv")
    csv_file(folder, lines(["smartphone"], [1]), "2.csv")
    run()
    csv_file(folder, lines(["desktop", "smartphone"], [2, 3]), "3.csv")
    run()
    run()
    batch = minhash.minhash_signatures(csv_report.read_rank_csv(spark, str(folder)), k=16)
    streamed = signature_table.read_signatures(spark, path, k=16)
    assert sorted(rows(streamed)) == sorted(rows(batch))
    assert len({p.name for p in (tmp_path / "sig").glob("part=*")}) == 3


def test_scratch_folder_is_new_and_below_the_checkpoint_dir(spark):
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first != second
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or first.startswith(f"{base.rstrip('/')}/a-")


def test_text_columns(spark):
    df = spark.createDataFrame([(day(1), 3), (day(2), 0)], "d date, n int")
    assert rows(df.select(day_text(F.col("d")), dot_bar(F.col("n")).alias("bar"))) == [
        ("2017-07-01", "..."),
        ("2017-07-02", ""),
    ]


def test_report_from_csv(spark, tmp_path):
    tune(spark)
    text = "".join(
        f"a,US,,{device},2017-07-0{n},{rank},{url}\n" for device, n, rank, url in
        [("desktop", 1, 1, "u1"), ("smartphone", 1, 1, "u1"), ("desktop", 2, 1, "u2"),
         ("desktop", 1, 11, "u3"), ("desktop", 1, 11, "u3")]
    )
    out = tmp_path / "out"
    answers = report.run_report(spark, csv_file(tmp_path, text), str(tmp_path / "t"), str(out))
    assert rows(answers["top_urls"]) == [("u3", 1)]
    assert rows(answers["exact_similarity"]) == [(day(1), 50), (day(2), 0)]
    assert rows(answers["top_spot_changes"]) == [("a", "US", "", "desktop", 1)]
    written = "".join(p.read_text() for p in sorted(out.glob("part-*"))).splitlines()
    assert written[0] == "Most frequent URL: u3 (1 times)"
    assert written[1] == "Left rank 1 most: a, US, , desktop, u1 (1 times)"
    assert written[2] == "Rank 1 changed most: a, US, , desktop (1 times)"
    assert written[-2:] == [f"Exact 2017-07-01: 50% {'.' * 50}", "Exact 2017-07-02: 0% "]


def test_report_of_the_event_view_has_both_similarities(spark):
    clean = cleaning.clean_ranks(rank_facts(spark, "/root/testdata/sf0.001"), ["event_id"])
    compared = report.analyses(clean)["estimate_vs_exact"]
    assert compared.columns == ["crawl_date", "estimate", "exact", "difference"]
    assert compared.count() == 30


def test_signatures_of_other_settings_are_an_error(spark, tmp_path):
    path = str(tmp_path / "signatures")
    made = {"md5": "a", "xxhash64": "b"}
    for element_id, part in made.items():
        settings = signature_table.signature_settings(16, element_id=element_id)
        signatures = minhash.minhash_signatures(edge_facts(spark), 16, element_id=element_id)
        signature_table.write_signature_part(signatures, path, part, settings)
    with pytest.raises(Exception, match="other settings"):
        signature_table.read_signatures(spark, path, 16).collect()


def test_a_new_checkpoint_keeps_earlier_parts(spark, tmp_path):
    path, folder = str(tmp_path / "signatures"), tmp_path / "reports"
    folder.mkdir()
    for n in (1, 2):
        (folder / f"{n}.csv").write_text(f"k,m,l,d,c,r,u\na,US,,desktop,2017-07-0{n},1,u{n}\n")
        stream = csv_report.stream_rank_csv(spark, str(folder))
        query = maintain_signatures(stream, path, str(tmp_path / f"checkpoint{n}"), "s", k=16, once=True)
        query.awaitTermination()
        (folder / f"{n}.csv").unlink()
    assert signature_table.read_signatures(spark, path, 16).count() == 2


def test_bad_signature_arguments(spark):
    df = edge_facts(spark)
    for wrong in (
        {"semantics": "compat", "modulus": 7, "k": 7},
        {"semantics": "compat", "modulus": 7, "method": "functions"},
        {"semantics": "compat"},
        {"modulus": 7},
        {"method": "bins", "pairs": [(1, 2)]},
        {"pairs": [(1, 2)], "k": 2},
        {"devices": ("a", "a")},
        {"method": "nonsense"},
        {"element_id": "nonsense"},
    ):
        with pytest.raises(ValueError):
            minhash.minhash_similarity(df, **wrong)


def test_empty_bins_are_no_shared_values(spark):
    df = facts(spark, [fact(d, url=f"{d}{n}") for d in ("desktop", "smartphone") for n in range(20)])
    got = minhash.minhash_similarity(df, method="bins", estimator="value_set")
    assert rows(got) == [(day(1), 0)]
