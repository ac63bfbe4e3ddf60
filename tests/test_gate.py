"""File gate verdicts on hand-made landing files (FIXTURES.md §5)."""

import os

from stayline.streaming import gate as G

ENC_HEADER = ("Id,START,STOP,PATIENT,ORGANIZATION,PROVIDER,PAYER,ENCOUNTERCLASS,CODE,"
              "DESCRIPTION,BASE_ENCOUNTER_COST,TOTAL_CLAIM_COST,PAYER_COVERAGE,REASONCODE,"
              "REASONDESCRIPTION")
ENC_ROW = ("e1,2020-01-01T00:00:00Z,2020-01-01T01:00:00Z,p1,o,pr,pa,inpatient,1,\"A, B\","
           "1.00,2.00,3.00,,")


def _write(root, name, text, bom=False):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        if bom:
            f.write(b"\xef\xbb\xbf")
        f.write(text.encode())


def test_gate_verdicts(spark, tmp_path):
    root = str(tmp_path / "landing")
    _write(root, "encounters.csv", ENC_HEADER + "\n" + ENC_ROW + "\n")
    _write(root, "patients.csv", "ID,BIRTHDATE,GENDER\nx,2000-01-01,F\n")
    _write(root, "observations.csv", "DATE,PATIENT,CODE,VALUE\n2020-01-01T00:00:00Z,p,c,1\n",
           bom=True)
    _write(root, "conditions.csv", "")
    _write(root, "procedures.csv", "START,PATIENT,CODE,DESCRIPTION\n")
    _write(root, "medications.csv", "START,PATIENT\n2020-01-01T00:00:00Z,p\n")
    _write(root, "other.csv", "a,b\n1,2\n")
    _write(root, "quarantine/patients.csv", "ID\n1\n")
    res = {r["key"]: (r["status"], r["reason"])
           for r in G.gate_batch(spark, root, expected=list(G.REQUIRED_COLUMNS)).collect()}
    assert res["encounters.csv"] == ("ACCEPTED", "15 columns, sample OK")
    assert res["patients.csv"] == ("REJECTED", "missing columns: [Id]")
    assert res["observations.csv"] == ("ACCEPTED", "4 columns, sample OK")
    assert res["conditions.csv"] == ("REJECTED", "empty file, no header")
    assert res["procedures.csv"] == ("REJECTED", "header present but no data rows")
    assert res["medications.csv"] == ("REJECTED", "missing columns: [CODE, DESCRIPTION]")
    assert res["other.csv"] == ("SKIPPED", "not a tracked file")
    assert not any(k.startswith("quarantine/") for k in res)


def test_gate_stream_only_new_files(spark, tmp_path):
    root, work = str(tmp_path / "landing"), str(tmp_path / "work")
    _write(root, "encounters.csv", ENC_HEADER + "\n" + ENC_ROW + "\n")
    G.gate_stream(spark, root, work + "/audit", work + "/ckpt")
    _write(root, "patients.csv", "Id,BIRTHDATE,GENDER\nx,2000-01-01,F\n")
    G.gate_stream(spark, root, work + "/audit", work + "/ckpt")
    G.gate_stream(spark, root, work + "/audit", work + "/ckpt")
    rows = spark.read.parquet(work + "/audit").collect()
    assert sorted((r["key"], r["status"]) for r in rows) == [
        ("encounters.csv", "ACCEPTED"), ("patients.csv", "ACCEPTED")]


def test_quarantine_is_idempotent(spark, tmp_path):
    root, dest = str(tmp_path / "landing"), str(tmp_path / "quarantine")
    _write(root, "encounters.csv", ENC_HEADER + "\n" + ENC_ROW + "\n")
    _write(root, "patients.csv", "ID,BIRTHDATE,GENDER\nx,2000-01-01,F\ny,2001-01-01,M\n")
    res = G.gate_batch(spark, root, expected=list(G.REQUIRED_COLUMNS))
    G.quarantine(spark, root, res, dest)
    G.quarantine(spark, root, res, dest)
    q = spark.read.parquet(dest)
    assert q.count() == 3                               # header + two rows, once
    assert {r["key"] for r in q.select("key").distinct().collect()} == {"patients.csv"}


def test_gate_reads_records_not_prefixes(spark, tmp_path):
    """Long headers, quoted line breaks, blanks in names, URI roots."""
    root = str(tmp_path / "land ing")
    edge = "START,PATIENT,CODE,DESCRIPTION"
    edge += "," + "x" * (64 * 1024 - len(edge) - 2)     # the line ends on a 64 KiB edge
    _write(root, "medications.csv", edge + "\n" + "1,2,3,4,5\n")
    wide = ENC_HEADER + "".join(f",c{i}" for i in range(150_000))  # over 1 MiB
    _write(root, "encounters.csv/part a%20b.csv", wide + "\n" + ENC_ROW + "\n")
    _write(root, "encounters.csv/part two.csv", '"a\nb",' + ENC_HEADER + "\nx," + ENC_ROW + "\n")
    _write(root, "procedures.csv", ",,\n1,2,3\n")
    for r in (root, "file:" + root, "file://" + root):
        res = {x["key"]: (x["status"], x["reason"]) for x in G.gate_batch(spark, r).collect()}
        assert res == {
            "medications.csv": ("ACCEPTED", "5 columns, sample OK"),
            "encounters.csv/part a%20b.csv": ("ACCEPTED", "150015 columns, sample OK"),
            "encounters.csv/part two.csv": ("ACCEPTED", "16 columns, sample OK"),
            "procedures.csv": ("REJECTED", "missing columns: [CODE, DESCRIPTION, PATIENT, START]"),
        }


def test_gate_by_text_reader_agrees(spark, tmp_path):
    """File systems Arrow does not know are read through Spark's text reader."""
    root = str(tmp_path / "landing")
    _write(root, "encounters.csv", '"a\nb",' + ENC_HEADER + "\nx," + ENC_ROW + "\n", bom=True)
    _write(root, "patients.csv", "Id,BIRTHDATE,GENDER\n")
    _write(root, "observations.csv", "DATE,PATIENT,CODE\n1,2,3\n")
    lines = spark.read.option("recursiveFileLookup", "true").text(root).where(
        "_metadata.file_block_start = 0").selectExpr("url_decode(_metadata.file_path) AS path", "value")
    heads = lines.mapInPandas(G._line_reader(), G.HEAD_SCHEMA).withColumn("key", G._rel_key(G.F.col("path"), root))
    assert sorted(G.verdicts(heads).collect()) == sorted(G.gate_batch(spark, root).collect())


def test_unreadable_file_is_a_verdict(spark, tmp_path):
    root = str(tmp_path / "landing")
    _write(root, "encounters.csv", ENC_HEADER + "\n" + ENC_ROW + "\n")
    files = G.listing(spark, root).unionByName(
        spark.createDataFrame([(f"file:{root}/patients.csv", 1)], "path string, length long"))
    res = {r["key"]: r for r in G.verdicts(G.file_heads(files, root)).collect()}
    assert res["encounters.csv"]["status"] == "ACCEPTED"
    assert res["patients.csv"]["status"] == "REJECTED"
    assert res["patients.csv"]["reason"].startswith("could not read: FileNotFoundError")


def test_quarantine_takes_files_out_of_landing(spark, tmp_path):
    root, dest = str(tmp_path / "landing"), str(tmp_path / "quarantine")
    _write(root, "encounters.csv", ENC_HEADER + "\n" + ENC_ROW + "\n")
    _write(root, "patients.csv/part [1] a.csv", "ID,BIRTHDATE,GENDER\nx,2000-01-01,F\n")
    _write(root, "conditions.csv", "START\n2000-01-01\n")
    res = spark.createDataFrame(G.gate_batch(spark, root).collect(), "key string, status string, reason string")
    q = G.quarantine(spark, root, res, dest, remove=True, slice_files=1)
    assert sorted((r["key"], r["value"]) for r in q.collect()) == [
        ("conditions.csv", "2000-01-01"), ("conditions.csv", "START"),
        ("patients.csv/part [1] a.csv", "ID,BIRTHDATE,GENDER"), ("patients.csv/part [1] a.csv", "x,2000-01-01,F")]
    left = [r["key"] for r in G.gate_batch(spark, root).collect()]
    assert left == ["encounters.csv"]


def test_missing_tables_of_a_stream(spark, tmp_path):
    root, work = str(tmp_path / "landing"), str(tmp_path / "work")
    _write(root, "encounters.csv", ENC_HEADER + "\n" + ENC_ROW + "\n")
    G.gate_stream(spark, root, work + "/audit", work + "/ckpt")
    gone = G.missing_tables(spark.read.parquet(work + "/audit"), list(G.REQUIRED_COLUMNS))
    assert sorted(r["key"] for r in gone.collect()) == sorted(set(G.REQUIRED_COLUMNS) - {"encounters.csv"})


def test_summary_shows_a_lost_or_repeated_part_file(spark):
    from stayline.plans.q_files import summarize
    cols = "key string, table_key string, status string, reason string"
    v = [(f"a.csv/part-{i}", "a.csv", "ACCEPTED", "ok") for i in range(3)] + [("b.csv", "b.csv", "REJECTED", "absent")]
    files = spark.createDataFrame([(f"a.csv/part-{i}", True) for i in range(3)], "key string, landed boolean")

    def rows(judged):
        return sorted(map(tuple, summarize(spark.createDataFrame(judged, cols), files).collect()))
    whole = [("a.csv", "ACCEPTED", "ok"), ("b.csv", "REJECTED", "absent")]
    assert rows(v) == whole
    assert rows(v[1:]) == [whole[0], ("a.csv", "LOST", "landed without a verdict"), whole[1]]
    assert rows([v[0], *v]) == [whole[0], ("a.csv", "REPEATED", "ok"), whole[1]]


def _landing(root):
    _write(root, "encounters.csv", ENC_HEADER + "\n" + ENC_ROW + "\n")
    _write(root, "patients.csv/part [1] a.csv", "ID,BIRTHDATE,GENDER\nx,2000-01-01,F\n")
    _write(root, "observations.csv", "DATE,PATIENT,CODE,VALUE\n")
    _write(root, "other.csv", "a\n1\n")
    _write(root, "quarantine/patients.csv", "ID\n1\n")


def test_stream_on_a_file_system_arrow_lacks(spark, tmp_path, monkeypatch):
    """The batch's files go through Spark's text reader: same verdicts, batch by batch."""
    root, work = str(tmp_path / "landing"), str(tmp_path / "work")
    _landing(root)
    want = sorted(map(tuple, G.gate_batch(spark, root).collect()))
    monkeypatch.setattr(G, "ARROW_SCHEMES", {})
    G.gate_stream(spark, root, work + "/audit", work + "/ckpt", max_files=2)
    audit = spark.read.parquet(work + "/audit")
    assert sorted(map(tuple, audit.select(*G.VERDICT_COLUMNS).collect())) == want
    assert audit.select("batch").distinct().count() > 1
    assert sorted(map(tuple, G.gate_batch(spark, root).collect())) == want


def test_files_arrow_cannot_open_are_tried_by_the_text_reader(spark, tmp_path, monkeypatch):
    """As on an object store whose credentials only Hadoop has; a file nobody can read keeps its own verdict."""
    root = str(tmp_path / "landing")
    _landing(root)
    want = sorted(map(tuple, G.gate_batch(spark, root).collect()))
    monkeypatch.setattr(G, "ARROW_SCHEMES", {"": "s3", "file": "s3"})
    assert sorted(map(tuple, G.gate_batch(spark, root).collect())) == want
    heads = G._named_heads(spark, [f"{root}/encounters.csv", f"{root}/absent.csv", f"{root}/observations.csv"])
    got = {r["path"].rsplit("/", 1)[1]: r["error"] for r in heads.collect()}
    assert got["encounters.csv"] is None and got["observations.csv"] is None
    assert "absent.csv" in got["absent.csv"] or "PATH_NOT_FOUND" in got["absent.csv"]


def test_a_replayed_batch_leaves_the_same_rows(spark, tmp_path):
    audit = str(tmp_path / "audit")
    rows = spark.createDataFrame([("a.csv", "SKIPPED", "x")], "key string, status string, reason string")
    for _ in range(2):
        G._commit(rows, audit, "gate", 7)
    G._commit(rows, audit, "gate", 8)
    assert spark.read.parquet(audit).count() == 2


def test_missing_tables_are_told_by_the_stream(spark, tmp_path):
    """One REJECTED row when a table's timer ends, one ARRIVED row when it lands later, nothing twice."""
    import time

    root, work = str(tmp_path / "landing"), str(tmp_path / "work")
    _write(root, "encounters.csv", ENC_HEADER + "\n" + ENC_ROW + "\n")
    expected = ["encounters.csv", "patients.csv", "conditions.csv"]

    def told():
        try:
            df = spark.read.parquet(work + "/audit").where("source = 'arrivals'")
            return sorted((r["key"], r["status"]) for r in df.collect())
        except Exception:  # noqa: BLE001  nothing written yet
            return []

    def until(want):
        end = time.time() + 90
        while told() != want and time.time() < end:
            time.sleep(0.5)
        assert told() == want

    q = G.arrivals(spark, root, work + "/audit", work + "/ckpt", expected, wait_seconds=1, interval="500 milliseconds")
    try:
        missing = [("conditions.csv", "REJECTED"), ("patients.csv", "REJECTED")]
        until(missing)
        _write(root, "patients.csv", "Id,BIRTHDATE,GENDER\nx,2000-01-01,F\n")
        until(sorted(missing + [("patients.csv", "ARRIVED")]))
        time.sleep(3)  # further timers and batches add nothing
        assert told() == sorted(missing + [("patients.csv", "ARRIVED")])
    finally:
        q.stop()


def test_quarantine_is_restarted_between_its_phases(spark, tmp_path, monkeypatch):
    root, dest = str(tmp_path / "landing"), str(tmp_path / "quarantine")
    _landing(root)
    res = spark.createDataFrame(G.gate_batch(spark, root).collect(), "key string, status string, reason string")
    G.quarantine(spark, root, res, dest)             # copied and committed, then killed before the removal
    lines = sorted(map(tuple, G.quarantined(spark, dest).collect()))
    assert len(lines) == 3 and G._manifest(spark, dest).count() == 2
    G.quarantine(spark, root, res, dest, remove=True)
    assert sorted(map(tuple, G.quarantined(spark, dest).collect())) == lines
    assert G._manifest(spark, dest).count() == 2     # nothing was copied again
    assert sorted(r["key"] for r in G.gate_batch(spark, root).collect()) == ["encounters.csv", "other.csv"]
    _write(root, "observations.csv", "DATE,PATIENT,CODE\n1,2,3\n")  # a new file under an old name
    res = spark.createDataFrame(G.gate_batch(spark, root).collect(), "key string, status string, reason string")
    monkeypatch.setattr(G, "ARROW_SCHEMES", {})      # removed by Spark's own file system
    G.quarantine(spark, root, res, dest, remove=True)
    assert G._manifest(spark, dest).count() == 3
    assert {r["value"] for r in G.quarantined(spark, dest).where("key = 'observations.csv'").collect()} == {
        "DATE,PATIENT,CODE", "1,2,3"}
    assert sorted(r["key"] for r in G.gate_batch(spark, root).collect()) == ["encounters.csv", "other.csv"]
