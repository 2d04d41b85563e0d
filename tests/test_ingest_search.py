import pytest
from pyspark.sql import functions as F
from samples import JUDGMENT, pdf_of

from lexmill.api import Engine, NotFound
from lexmill.config import Settings
from lexmill.operators import keyed, runs
from lexmill.operators.search import Filters, IndexEmptyError, Request
from lexmill.plans import ingest
from lexmill.sources import pdf
from lexmill.sources.store import CommitConflict, Store
from lexmill.streaming.incremental import watch

SMALL = Settings(chunk_size=80, chunk_overlap=16)


def variant(number: int, subject: str) -> str:
    return JUDGMENT.replace("4321", str(number)).replace("RAMESH TRADERS", f"PARTY {chr(65 + number % 26)}") + "\n" + (f"The question concerns {subject} and nothing but {subject}. " * 6)


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "pdfs" / "deep"
    d.mkdir(parents=True)
    (d / "a.pdf").write_bytes(pdf_of(variant(1, "anticipatory bail")))
    (d / "b.pdf").write_bytes(pdf_of(variant(2, "land acquisition"), compress=False))
    (d / "c.pdf").write_bytes(b"%PDF-1.4 broken")
    (d / "d.PDF").write_bytes(pdf_of(variant(3, "taxes")))
    (d / "e.pdf").write_bytes(pdf_of(variant(1, "another file of the same case")))
    return tmp_path / "pdfs"


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    s.create()
    return s


def test_extraction(spark, folder):
    found = pdf.discover(spark, str(folder))
    assert found.count() == 4 and pdf.discover(spark, str(folder), 2).count() == 2
    rows = {r["file_name"]: r for r in pdf.extract(pdf.load(spark, str(folder), found)).collect()}
    assert rows["a.pdf"]["success"] and "anticipatory bail" in rows["a.pdf"]["raw_text"] and rows["a.pdf"]["page_count"] == 1 and rows["a.pdf"]["extraction_method"] == "builtin"
    assert not rows["c.pdf"]["success"] and rows["c.pdf"]["raw_text"] == "" and rows["c.pdf"]["extraction_method"] == "failed" and rows["c.pdf"]["extraction_error"]
    assert len(rows["a.pdf"]["file_hash"]) == 64


def test_cascade_is_lazy():
    seen = []

    def never(content):
        seen.append(content)
        raise AssertionError

    assert pdf.first_sufficient(b"x", (("short", lambda c: ("few", 1)), ("good", lambda c: ("y" * 200, 2)), ("never", never)))[:3] == ("y" * 200, 2, "good")
    assert not seen


def test_ingest_is_resumable_and_idempotent(spark, folder, store):
    first = ingest.run(spark, store, str(folder), SMALL)
    assert (first["total"], first["processed"], first["skipped"], first["failed"]) == (4, 2, 0, 2) and first["vectors"] > 4
    ids = lambda: {(r["case_id"], r["chunk_index"], r["vec_id"]) for r in store.read("chunks").collect()}
    before = ids()
    assert min(v for _, _, v in before) == 0 and len({v for _, _, v in before}) == len(before) == store.read("index").count()
    again = ingest.run(spark, store, str(folder), SMALL)
    assert (again["processed"], again["skipped"], again["failed"], again["vectors"]) == (0, 4, 0, first["vectors"]) and ids() == before
    retried = ingest.run(spark, store, str(folder), SMALL, retry_failed=True)
    assert (retried["processed"], retried["skipped"], retried["failed"]) == (0, 2, 2)
    states = {r["file_path"].rsplit("/", 1)[1]: (r["status"], r["error"]) for r in store.read("checkpoint").collect()}
    assert states["a.pdf"][0] == "done" and states["c.pdf"][0] == "failed" and "another file" in states["e.pdf"][1]
    run = runs.run_state(store.read("runs"), first["run_id"]).first()
    assert run["status"] == "completed" and run["processed_files"] == 2 and run["started_at"] is not None and run["completed_at"] is not None


def test_same_content_under_another_path_replaces(spark, folder, store):
    ingest.run(spark, store, str(folder), SMALL)
    n = store.read("chunks").count()
    (folder / "copy.pdf").write_bytes((folder / "deep" / "a.pdf").read_bytes())
    assert ingest.run(spark, store, str(folder), SMALL)["processed"] == 1
    assert store.read("chunks").count() == n and store.read("cases").count() == 2
    case = store.read("cases").where("case_id like 'civil_appeal_no_1_%'").first()
    assert case["file_name"] == "copy.pdf" and case["updated_at"] >= case["created_at"]


def test_stream_ingests_new_files_once(spark, folder, store, tmp_path):
    go = lambda: watch(spark, store, str(folder), str(tmp_path / "log"), SMALL).awaitTermination(120)
    go()
    assert store.read("cases").count() == 2
    number = store.manifest()[0]
    go()
    assert store.manifest()[0] == number
    (folder / "f.pdf").write_bytes(pdf_of(variant(9, "sedition")))
    go()
    assert store.read("cases").count() == 3


def test_search(spark, folder, store):
    engine = Engine(spark, store.root, SMALL)
    with pytest.raises(IndexEmptyError):
        engine.search(Request("anything"))
    engine.start_ingest(str(folder), wait=True)
    got = engine.search(Request("anticipatory bail", top_k=3)).first()
    assert got["total_hits"] == 3 == len(got["results"]) and [h["rank"] for h in got["results"]] == [1, 2, 3]
    assert got["results"][0]["case"]["case_id"] == "civil_appeal_no_1_of_2018" and "anticipatory" in got["results"][0]["chunk_text"]
    scores = [h["score"] for h in got["results"]]
    assert scores == sorted(scores, reverse=True)
    hidden = engine.search(Request("anticipatory bail", top_k=1, include_chunk_text=False)).first()
    assert hidden["results"][0]["chunk_text"] is None
    none = engine.search(Request("anticipatory bail", filters=Filters(case_type="criminal"))).first()
    assert none["total_hits"] == 0 and none["results"] == []
    some = engine.search(Request("anticipatory bail", filters=Filters(2018, 2018, "APPEAL", "allow", "anand", "penal"), mode="pre")).first()
    assert some["total_hits"] == store.read("chunks").count() if store.read("chunks").count() < 10 else 10
    assert engine.stats().first()["cases"] == 2 and engine.case("civil_appeal_no_2_of_2018").first()["petitioner"] == "PARTY C"
    with pytest.raises(NotFound):
        engine.case("no such case")
    with pytest.raises(NotFound):
        engine.run_status("no such run")
    with pytest.raises(ValueError):
        engine.start_ingest("/no/such/folder")
    assert ingest.rebuild_lists(store, 3) == 3
    assert engine.search(Request("anticipatory bail", top_k=1)).first()["results"][0]["case"]["case_id"] == "civil_appeal_no_1_of_2018"


@pytest.mark.parametrize("bad", [{"query": "ab"}, {"query": "abc", "top_k": 0}, {"query": "abc", "top_k": 51}, {"query": "abc", "mode": "x"}])
def test_requests_are_checked(bad):
    with pytest.raises(ValueError):
        Request(**bad)
    with pytest.raises(ValueError):
        Filters(year_from=1900)


def test_filters_let_missing_fields_through(spark):
    cases = spark.createDataFrame([(None, None, None, None), (2000, "Civil Appeal", ["A. Roy"], []), (1990, "SLP (Civil)", [], ["IPC"])], "year int, case_type string, judges array<string>, acts_cited array<string>").withColumn("outcome", F.lit(None).cast("string"))
    count = lambda **f: cases.where(Filters(**f).condition()).count()
    assert count() == 3 and count(year_from=1995) == 2 and count(case_type="civil") == 3 and count(case_type="slp") == 2
    assert count(judge_name="ROY") == 3 and count(judge_name="bose") == 2 and count(act_cited="crpc") == 2 and count(outcome="x") == 3


def test_commits_do_not_overwrite_each_other(spark, store, monkeypatch):
    rows = spark.createDataFrame([(0, [1.0])], "list_id int, centre array<double>")
    store.commit({"centres": rows})
    monkeypatch.setattr(store, "manifest", lambda: (0, {}))
    with pytest.raises(CommitConflict):
        store.commit({"centres": rows})


def test_upsert_keeps_the_creation(spark):
    t = "timestamp_ntz"
    table = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").withColumn("created_at", F.lit("2020-01-01").cast(t)).withColumn("updated_at", F.lit("2020-01-01").cast(t))
    new = spark.createDataFrame([("b", 5), ("c", 6)], "k string, v int")
    got = {r["k"]: (r["v"], r["created_at"].year, r["updated_at"].year) for r in keyed.upsert(table, new, "k", now=F.lit("2024-01-01").cast(t)).collect()}
    assert got == {"a": (1, 2020, 2020), "b": (5, 2020, 2024), "c": (6, 2024, 2024)}


def test_checkpoint_states(spark):
    files = spark.createDataFrame([("new",), ("done",), ("failed",), ("begun",)], "file_path string")
    point = spark.createDataFrame([("done", "done"), ("failed", "failed"), ("begun", "in_progress")], "file_path string, status string")
    left = lambda retry: {r[0] for r in runs.unprocessed(files, point, retry).collect()}
    assert left(False) == {"new", "begun"} and left(True) == {"new", "begun", "failed"}
    long = runs.transitions(files, runs.FAILED, error=F.lit("x" * 3000))
    assert long.select(F.length("error")).first()[0] == 2000
    merged = runs.merge_checkpoint(runs.transitions(files, runs.IN_PROGRESS), runs.transitions(files.where("file_path = 'new'"), runs.DONE))
    assert {r["status"]: r["n"] for r in runs.status_counts(merged).collect()} == {"in_progress": 3, "done": 1}


def test_settings(monkeypatch, tmp_path):
    (tmp_path / ".env").write_text("LEXMILL_TOP_K=7\nLEXMILL_CHUNK_SIZE='99'\n# no\n")
    monkeypatch.setenv("LEXMILL_TOP_K", "8")
    s = Settings.load(str(tmp_path / ".env"))
    assert s.top_k == 8 and s.chunk_size == 99 and s.chunk_overlap == 64


def test_a_commit_writes_what_is_new(spark, store, folder, tmp_path, monkeypatch):
    """One more file adds its own rows only; long lists of changes become one again; old folders go with their manifests."""
    from lexmill.sources import store as stores

    ingest.run(spark, store, str(folder), SMALL)
    before = {t: store.manifest()[1][t] for t in ("cases", "chunks", "index", "checkpoint")}
    old = sorted(map(tuple, store.read("chunks").collect()))
    more = tmp_path / "more"
    more.mkdir()
    (more / "z.pdf").write_bytes(pdf_of(variant(9, "a lease")))
    ingest.run(spark, store, str(more), SMALL)
    held = store.manifest()[1]
    for t, changes in before.items():
        assert held[t][: len(changes)] == changes
        added = [c for c in held[t][len(changes) :] if c["gone"] is None]
        rows = spark.read.schema(stores.TABLES[t]).parquet(*[f"{store.root}/{t}/{c['folder']}" for c in added])
        own = {"cases": "case_number like '% 9 %'", "chunks": "case_id like '%no_9_%'", "index": "case_id like '%no_9_%'", "checkpoint": "file_path like '%z.pdf'"}[t]
        assert len(added) == 1 and rows.count() == rows.where(own).count() > 0
    assert set(old) < set(map(tuple, store.read("chunks").collect())) and store.read("cases").count() == 3
    now = {t: sorted(map(str, store.read(t).collect())) for t in before}
    monkeypatch.setattr(stores, "MOST_CHANGES", 1)
    store.commit({t: stores.Change() for t in before})
    assert {t: len(store.manifest()[1][t]) for t in before} == dict.fromkeys(before, 1)
    assert store.vacuum(keep=1) > 0 and {t: sorted(map(str, store.read(t).collect())) for t in before} == now


def test_lists_are_made_by_an_ingest_that_is_asked_to(spark, store, folder):
    import dataclasses

    ingest.run(spark, store, str(folder), dataclasses.replace(SMALL, n_lists=2))
    assert store.read("centres").count() == 2 and store.read("index").select("list_id").distinct().count() <= 2
    hits = Engine(spark, store.root, dataclasses.replace(SMALL, n_probe=2)).search(Request("anticipatory bail", 3)).first()
    assert hits["total_hits"] > 0
    assert ingest.rebuild_lists(store, 10**6) == 0 and store.read("centres").count() == 2


def test_a_database_gets_and_gives_back_a_table(spark, store, folder):
    """By Spark's own embedded database: append, replace by key, read."""
    ingest.run(spark, store, str(folder), SMALL)
    url = "jdbc:derby:memory:lexmill;create=true"
    string = {"createTableColumnTypes": "file_path VARCHAR(4000), case_id VARCHAR(200), file_hash VARCHAR(100)"}
    store.export_jdbc("cases", url, key="file_hash", **string)
    store.export_jdbc("cases", url, key="file_hash", **string)
    back = store.import_jdbc("cases", url)
    same = lambda rows: sorted(str(r) for r in rows.drop("created_at", "updated_at").collect())
    assert same(back) == same(store.read("cases")) and back.count() == 2
    store.export_jdbc("cases", url, **string)
    assert store.import_jdbc("cases", url).count() == 4


def test_command_line_and_health(spark, folder, tmp_path, capsys, monkeypatch):
    import json

    from lexmill.__main__ import main

    monkeypatch.chdir(tmp_path)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    at = ["--store", f"file://{tmp_path}/cli"]
    shown = lambda: json.loads(capsys.readouterr().out.strip().split("\n")[-1])
    try:
        main([*at, "init", "--drop-all"])
        main([*at, "ingest", "--pdf-dir", str(folder), "--limit", "2"])
        assert shown()["processed"] == 2
        main([*at, "ingest", "--pdf-dir", str(folder), "--embedding-batch-size", "7"])
        assert shown()["skipped"] == 2 and spark.conf.get(batch) == "7"
        main([*at, "lists", "--n-lists", "2"])
        assert shown() == {"lists": 2}
        main([*at, "search", "anticipatory bail", "--top-k", "1", "--year-from", "2000"])
        found = shown()
        assert found["total_hits"] == 1 and found["results"][0]["case"]["year"] == 2018
    finally:
        spark.conf.unset(batch)
    assert Engine(spark, f"file://{tmp_path}/cli", SMALL).health() == {"status": "ok"}
