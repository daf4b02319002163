"""Files in and out, and the audited build."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import rows

from funnelworks.model import Exports
from funnelworks.operators.dedupe import keep_first
from funnelworks import registry
from funnelworks.plans.analyses import ANALYSES
from funnelworks.plans.build import EXPORTS, build, current_build, read_published_views
from funnelworks.plans.cleaning import Cleaning
from funnelworks.plans.model import report_model
from funnelworks.plans.quality import GateError, Quality, totals
from funnelworks.plans.reconcile import kpi_summary
from funnelworks.plans.suite import execute, require_success, run_log
from funnelworks.registry import spans
from funnelworks.schemas import EXPORT_SCHEMAS
from funnelworks.session import together, work_dir
from funnelworks.sources import exports as io
from funnelworks.sources.messy import MessyExports
from funnelworks.sources.stages import Stages, get, put, version_of
from funnelworks.sources.tables import MARKER, read_published
from funnelworks.sources.warehouse import Warehouse

SMALL = "/root/testdata/sf0.001"


def test_csv_types_and_positions(spark, tmp_path):
    folder = tmp_path / "crm_leads_export.csv"
    folder.mkdir()
    head = ",".join(EXPORT_SCHEMAS["leads"])
    (folder / "part-0.csv").write_text(
        f"{head}\n1.0,2026-01-05 10:00,Google Ads,A,Liège,1-9,Bar,54.0,1,0\n,2026-01-05 10:00,x,A,Namur,,Bar,,0,0\n"
        "2.0,when?,x,A,Namur,1-9,Bar,oops,1,1\n",
        encoding="utf-8",
    )
    many = "\n".join(f"{i},2026-01-06,x,A,Namur,1-9,Bar,{i % 100},0,0" for i in range(2, 4000))
    (folder / "part-1.csv").write_text(f"{head}\n{many}\n", encoding="utf-8")
    df = io.read_export(spark, str(folder), EXPORT_SCHEMAS["leads"])
    ordered = rows(df, "_pos")
    assert [r["lead_id"] for r in ordered[:5]] == [1, None, 2, 2, 3] and ordered[-1]["lead_id"] == 3999
    assert ordered[0]["lead_score"] == 54.0 and ordered[2]["lead_score"] is None and ordered[1]["company_size"] is None
    kept = keep_first(df.where("lead_id = 2"), ["lead_id"]).first()
    assert (kept["created_at"], kept["_copies"]) == ("when?", 2)


def test_csv_as_tools_write_it(spark, tmp_path):
    columns = {"id": "int", "label": "string", "day": "string"}
    path = tmp_path / "export.csv"
    path.write_text('label,extra,day,id\n"Ads ""Brand""",x,2026-01-05,1\n"two\nlines",,2026-01-06,2\nplain,,,3\n')
    got = rows(io.read_export(spark, str(path), columns, multi_line=True), "id")
    assert [(r["id"], r["label"], r["day"]) for r in got] == [
        (1, 'Ads "Brand"', "2026-01-05"), (2, "two\nlines", "2026-01-06"), (3, "plain", None),
    ]
    split = io.read_csv(spark, str(path), columns).collect()  # without multi_line the break is seen, not swallowed
    assert any(r[io.CORRUPT] is not None for r in split)
    with pytest.raises(ValueError, match="no column other"):
        io.read_export(spark, str(path), {**columns, "other": "string"})


def test_quotes_survive_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "x", twice'), (2, None), (3, " blank ")], "id int, label string")
    io.write_csv(df, str(tmp_path / "out"))
    back = io.read_export(spark, str(tmp_path / "out"), {"id": "int", "label": "string"}).drop("_pos")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_run_log_shows_errors_and_goes_on(spark, built):
    broken = ("kpi", 1, "broken", lambda v: v.channel_performance.selectExpr("raise_error('no') AS x"))
    empty = ("kpi", 2, "empty", lambda v: v.channel_performance.where("false"))
    fine = ("kpi", 3, "fine", lambda v: v.channel_performance)
    log = {r.label: r for r in run_log(built.views, [broken, empty, fine]).collect()}
    assert log["broken"].status.startswith("ERROR") and log["broken"].rows_returned is None
    assert log["empty"].status == "EMPTY" and (log["fine"].status, log["fine"].rows_returned) == ("PASS", 6)
    assert log["fine"].ms >= 0 and log["sql_implies_mql"].status == "PASS"
    with pytest.raises(RuntimeError, match="broken"):
        require_success(spark.createDataFrame([execute(built.views, broken)], "suite string, number int, label string, rows_returned bigint, ms bigint, status string"))


def test_days_and_segments_come_from_the_tables(spark, tmp_path):
    """A day outside all others and an unknown segment are not lost."""
    base = Warehouse(spark, SMALL)
    for name in ("region", "nation", "lineitem"):
        base.table(name).write.parquet(str(tmp_path / f"{name}.parquet"))
    customer, orders = base.table("customer"), base.table("orders")
    new = customer.limit(1).selectExpr("900001L AS c_custkey", "c_nationkey", "c_acctbal", "'ZEPPELIN' AS c_mktsegment")
    customer.unionByName(new).write.parquet(str(tmp_path / "customer.parquet"))
    late = orders.limit(1).selectExpr(
        "900003L AS o_orderkey", "900001L AS o_custkey", "o_orderstatus", "o_totalprice",
        "CAST('2031-05-06' AS timestamp_ntz) AS o_orderdate", "o_orderpriority",
    )
    orders.unionByName(late).write.parquet(str(tmp_path / "orders.parquet"))
    w = Warehouse(spark, str(tmp_path))
    assert w.period() == (base.period()[0], 20310531) and w.dim_date().where("date_key = 20310630").count() == 1
    assert tuple(w.dim_channel().where("channel_id > 6").first()) == (7, "ZEPPELIN", "Other", 0)
    lead = w.lead_base().where("lead_id = 900003").first()
    assert (lead.channel_id, lead.campaign_id, str(lead.created)) == (7, None, "2031-05-06")
    assert w.lead_base().count() == orders.count() + 1


def test_local_work_folder_without_settings(spark, monkeypatch):
    from funnelworks import session

    assert session._local_folder("one") == session._local_folder("one") != session._local_folder("two")


def test_reference_and_default_synonyms(spark, tmp_path):
    (tmp_path / "channels.csv").write_text("channel_id,channel_name,channel_group,is_paid\n1,Google Ads,Paid Search,1\n")
    (tmp_path / "campaigns.csv").write_text("campaign_id,campaign_name,channel_id,objective,start_date\n1,A,1,Leads,2025-11-01\n")
    (tmp_path / "regions.csv").write_text("region_id,region_name,region_group\n7,Liège,Wallonia\n", encoding="utf-8")
    ref = io.read_reference(spark, str(tmp_path))
    assert tuple(ref.channels.first()) == (1, "Google Ads", "Paid Search", 1)
    assert str(ref.campaigns.first()["start_date"]) == "2025-11-01"
    assert {r["name"] for r in rows(ref.synonyms.where("label IN ('luik', 'liege')"))} == {"Liège"}


@pytest.fixture(scope="module")
def delivered(spark):
    messy = MessyExports(Warehouse(spark, SMALL))
    folder = work_dir(spark, "test-csv")
    io.write_exports(messy.exports(), folder)
    return io.read_exports(spark, folder), messy.reference()


@pytest.fixture(scope="module")
def built(spark, delivered):
    raw, reference = delivered
    return build(spark, Cleaning(raw, reference, *spans(spark, SMALL)), work_dir(spark, "test-star"))


def test_build_from_csv_is_published(spark, built):
    star = read_published(spark, built.folder)
    assert star.period == Warehouse(spark, SMALL).period()
    assert star.fact_leads.count() == built.row_counts.where("table = 'Leads'").first()["clean_rows"]
    assert built.log.count() == 22 and built.checks.count() == 22
    assert totals(built.checks).first()["gate"] == "PASS"
    plan = star.fact_leads.where("created_date_key BETWEEN 19970101 AND 19970131")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(created_date_key)" in plan
    views = read_published_views(spark, built.folder)
    assert views.channel_performance.count() == 6


def test_exports_of_views_model_and_summary(spark, built, tmp_path):
    views = read_published_views(spark, built.folder)
    model = report_model(built.star, built.checks, built.row_counts, built.log)
    io.write_views(views, str(tmp_path / "views"))
    io.write_model(model, str(tmp_path / "model"))
    again = io.read_model(spark, str(tmp_path / "model"))
    for name in ("DimCampaign", "FactOpportunities", "DimDate", "DataQualityChecks", "CleaningLog"):
        assert again[name].dtypes == [(c, k) for c, k in model[name].dtypes], name
        assert sorted(map(repr, again[name].collect())) == sorted(map(repr, model[name].collect())), name
    summary = kpi_summary(views)
    io.write_json(summary, str(tmp_path / "kpi"))
    assert io.read_json(spark, str(tmp_path / "kpi"), summary.schema.simpleString()[7:-1].replace(":", " ")).first() == summary.first()


def test_samples(spark, delivered, tmp_path):
    raw, _ = delivered
    first = io.sample(raw.leads).collect()
    assert len(first) == 200 and first[0]["lead_id"] == 0
    io.write_samples(Exports({n: (lambda n=n: raw[n]) for n in Exports.names}), str(tmp_path))
    assert (tmp_path / "sample_crm_leads_export.csv").exists()


def test_gate_stops_a_bad_build(spark, delivered):
    raw, reference = delivered
    extra = {
        "date": "1996-05-01", "channel": "Unheard of", "campaign": "Campaign 01", "impressions": 1, "clicks": 1,
        "sessions": 1, "spend": Decimal("1.00"), "_pos": ("zzz", 0, 0),
    }
    bad_row = spark.createDataFrame([tuple(extra[c] for c in raw.marketing.columns)], raw.marketing.schema)
    tables = {n: (lambda n=n: raw[n]) for n in Exports.names}
    tables["marketing"] = lambda: raw.marketing.unionByName(bad_row)
    folder = work_dir(spark, "test-bad")
    with pytest.raises(GateError, match="DQ02"):
        build(spark, Cleaning(Exports(tables), reference, *spans(spark, SMALL)), folder)
    with pytest.raises(Exception, match=MARKER):
        read_published(spark, folder).fact_leads.count()


def test_quality_on_hand_made_rows(make_exports, reference, make_star):
    ad = ("2026-01-05", "Google Ads", "Brand", 100, 10, 5)
    size = ("1-9", "Bar")
    raw = make_exports(
        marketing=[
            (*ad, 10.0), (*ad, 10.0), ("2026-02-30", "google ads", "Brand", 10, 11, 1, -1.0),
            ("2026-01-06", None, "Brand", 10, 1, 1, 101.0), ("2026-01-07", "Email", "Brand", 10, 1, 1, 10.0),
        ],
        leads=[
            (1, "2026-01-05", "Email", "Brand", "Namur", *size, 50.0, 1, 1),
            (1, "2026-01-05", "Email", "BRAND ", "namur", *size, 101.0, 0, 1),
            (None, "2026-01-05", "Email", "Nope", None, None, "Bar", None, 0, 0),
        ],
        opportunities=[
            (1, 1, "2026-01-05", "2026-01-04", "won", "Pro", 1, 10.0, None),
            (1, 1, "2026-01-05", "2026-01-04", "won", "Pro", 1, 10.0, None),
            (2, 5, "2026-01-05", None, "Lost ", "Pro", 1, 10.0, -1.0),
            (3, None, "2026-01-05", "2026-01-05", None, "Pro", 1, 10.0, 0.0),
        ],
        customers=[(1, 1, "2026-01-05", "Pro", 1.0), (1, 1, "2026-01-05", "Pro", 2.0), (2, 3, "2026-01-05", "Pro", 1.0)],
    )
    q = Quality(raw, reference, make_star())
    found = {r["check_id"]: (r["raw"], r["clean"], r["status"]) for r in rows(q.checks)}
    assert {k: v[0] for k, v in found.items()} == {
        "DQ01": 1, "DQ02": 2, "DQ03": 1, "DQ04": 1, "DQ05": 1, "DQ06": 1, "DQ07": 1, "DQ08": 1, "DQ09": 1, "DQ10": 2,
        "DQ11": 1, "DQ12": 1, "DQ13": 1, "DQ14": 1, "DQ15": 1, "DQ16": 2, "DQ17": 4, "DQ18": 2, "DQ19": 1, "DQ20": 2,
        "DQ21": 1, "DQ22": 1,
    }
    assert {v[1:] for v in found.values()} == {(0, "PASS")}


def test_jobs_run_together_in_order():
    assert together([lambda i=i: i * i for i in range(9)]) == [i * i for i in range(9)]


def test_everything_is_exported_before_it_is_published(spark, built):
    """What other tools get is in the folder of the build, read back as it was computed."""
    folder = f"{built.folder}/{EXPORTS}"
    assert built.run_log.count() == 38 + 14 and built.run_log.where("status NOT IN ('PASS', 'EMPTY')").count() == 0
    for name in io.VIEW_NAMES:
        kinds = dict(getattr(built.views, name).dtypes)
        assert sorted(map(str, io.read_view(spark, f"{folder}/views", name, kinds).collect())) == sorted(
            map(str, getattr(built.views, name).collect())
        ), name
    assert io.read_model(spark, f"{folder}/model")["FactLeads"].count() == built.star.fact_leads.count()
    assert io.read_sample(spark, f"{folder}/samples/leads", "leads").count() == 200


class Killed(Exception):
    pass


def test_a_build_that_was_killed_goes_on(spark, tmp_path, monkeypatch):
    """Stopped in the views, then in an export: nothing is published until all is done, and no stage is done twice."""
    raw, reference = registry.delivered(spark, SMALL)
    make = lambda: Cleaning(raw, reference, *spans(spark, SMALL))
    folder, pointer = str(tmp_path / "build"), str(tmp_path / "current.json")
    seen = []

    def stop_at(name):
        plain = Stages.step

        def step(self, stage, work):
            if stage == name:
                work(f"{self.folder}/{stage}")  # written, but not recorded
                raise Killed(stage)
            return plain(self, stage, work)

        with monkeypatch.context() as m:
            m.setattr(Stages, "step", step)
            with pytest.raises(Killed):
                build(spark, make(), folder, pointer)
        seen.append({p.name for p in (tmp_path / "build" / "_stages").iterdir() if p.suffix == ".json"})
        with pytest.raises(Exception, match=MARKER):
            read_published(spark, folder)
        with pytest.raises(FileNotFoundError):
            current_build(spark, pointer)

    for name in ("views/campaign_performance", "exports/model/FactLeads"):
        stop_at(name)
    assert seen[0] < seen[1] and "work.lead_steps.json" in seen[0]
    stamps = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "build" / "_stages").iterdir()}
    done = build(spark, make(), folder, pointer)
    assert "exports.model.FactLeads.json" not in stamps and "exports/model/FactLeads" in done.stages
    assert not {n.replace("/", ".") + ".json" for n in done.stages} & set(stamps)
    assert all((tmp_path / "build" / "_stages" / n).stat().st_mtime_ns == t for n, t in stamps.items())
    assert current_build(spark, pointer) == folder
    whole = registry.built(spark, SMALL)
    for name in ("fact_leads", "dim_customer"):
        assert sorted(map(str, read_published(spark, folder)[name].collect())) == sorted(map(str, whole.star[name].collect()))
    again = build(spark, make(), folder, pointer)
    assert again.stages == () and again.log.count() == 22


def test_a_statement_that_fails_stops_the_build(spark, tmp_path, monkeypatch):
    raw, reference = registry.delivered(spark, SMALL)
    cleaning = lambda: Cleaning(raw, reference, *spans(spark, SMALL))
    folder = str(tmp_path / "build")
    broken = ("kpi", "broken", lambda v: v.channel_performance.selectExpr("raise_error('no') AS x"))
    with monkeypatch.context() as m:
        m.setitem(ANALYSES, "q99", broken)
        with pytest.raises(RuntimeError, match="q99: ERROR"):
            build(spark, cleaning(), folder)
    with pytest.raises(Exception, match=MARKER):
        read_published(spark, folder)
    log = spark.createDataFrame([("funnel", 1, "q19", 0, 5, "EMPTY")], "suite string, number int, label string, rows_returned bigint, ms bigint, status string")
    require_success(log, frozenset({"q19"}))
    with pytest.raises(RuntimeError, match="q19: EMPTY"):
        require_success(log)
    done = build(spark, cleaning(), folder)
    assert "run_log" in done.stages and "cleaning_log" not in done.stages


def test_versions_follow_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    first = version_of(spark, [spark.read.parquet(path)], "a")
    assert first == version_of(spark, [spark.read.parquet(path)], "a") != version_of(spark, [spark.read.parquet(path)], "b")
    spark.range(4).write.mode("overwrite").parquet(path)
    assert first != version_of(spark, [spark.read.parquet(path)], "a")
    assert version_of(spark, [spark.range(3)]) == version_of(spark, [spark.range(3)]) != version_of(spark, [spark.range(4)])
    rows = [spark.createDataFrame([(i,)], "i int") for i in range(2)]
    assert version_of(spark, rows[:1]) != version_of(spark, rows[1:])


def test_small_files_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "a" / "x.json")
    assert get(spark, path) is None
    put(spark, path, {"a": "é"})
    put(spark, path, {"a": 2})
    assert get(spark, path) == {"a": 2} and [p.name for p in (tmp_path / "a").iterdir() if not p.name.endswith(".crc")] == ["x.json"]


@pytest.mark.parametrize("split", [64, 301, 10**9])
def test_line_broken_csv_is_read_in_splits(spark, tmp_path, split):
    """Rows that go over lines and splits, doubled quotes, blank lines within quotes: as the csv module reads them."""
    import csv
    import random

    rnd = random.Random(split)
    folder = tmp_path / "export.csv"
    folder.mkdir()
    texts = ["plain", "two\nlines", 'a "quoted" word', "\n\nblank lines", 'x\n"y", z\n', "comma, here", "é\n" * 40, ""]
    for part in range(2):
        with open(folder / f"part-{part}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator="\n", doublequote=True)
            out.writerow(["id", "extra", "label", "day"])
            for i in range(150):
                out.writerow([part * 1000 + i, rnd.choice(texts), rnd.choice(texts), "2026-01-05"])
    want = []
    for part in range(2):
        with open(folder / f"part-{part}.csv", newline="", encoding="utf-8") as f:
            want += [(int(r["id"]), r["label"] or None, r["day"]) for r in csv.DictReader(f)]
    with_conf = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        df = io.read_export(spark, str(folder), {"id": "int", "label": "string", "day": "string"}, multi_line=True)
        got = df.orderBy("_pos").collect()
        parts = spark.read.text(str(folder)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", with_conf)
    assert [(r["id"], r["label"], r["day"]) for r in got] == want
    assert parts > 20 or split > 64


def test_line_broken_csv_shows_rows_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "export.csv"
    path.write_text('id,label\n1,"a\nb"\n2,x,too,many\n3,"c"\n')
    got = {r["id"]: (r["label"], r[io.CORRUPT]) for r in io.read_csv(spark, str(path), {"id": "int", "label": "string"}, multi_line=True).collect()}
    assert got["1"] == ("a\nb", None) and got["3"] == ("c", None) and got["2"][1] == "2,x,too,many"
