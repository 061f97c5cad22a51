"""Remote contents and the conversion service, against a server on this machine."""

from __future__ import annotations

import gzip
import json
import threading
import time
import urllib.error
import urllib.request
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tariffloom.operators import providers
from tariffloom.plans import api, jobs, resolve
from tariffloom.sources import files, writers


@pytest.fixture
def site():
    bodies = {"/a.json": b'{"provider_groups":[{"npi":[1,2]}]}', "/b.json.gz": gzip.compress(b'[{"npi":[3]}]'), "/t.csv": "Zip Code,zip-code\n1,é\n2,\n".encode()}

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            body = bodies.get(self.path)
            self.send_response(200 if body else 404)
            self.end_headers()
            self.wfile.write(body or b"")

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_contents_of_addresses(spark, site):
    urls = spark.createDataFrame([(f"{site}/{p}",) for p in ("a.json", "a.json", "b.json.gz", "none", "t.csv")] + [(None,), ("no address",)], "url string")
    got = {(r.url or "").rsplit("/", 1)[-1]: r for r in files.fetched(urls, wait=0.01).collect()}
    assert len(got) == 5 and got["b.json.gz"].value == '[{"npi":[3]}]' and got["none"].value is None and "404" in got["none"].error and got["no address"].error
    refs = spark.createDataFrame([("f", [(7, f"{site}/a.json"), (8, f"{site}/b.json.gz"), (9, f"{site}/none")])], "source_file string, provider_references array<struct<provider_group_id:int,location:string>>")
    links = providers.provider_links(refs)
    found = providers.linked_providers(links, files.fetched(links, "location", wait=0.01).where("value is not null").select("name", "value"))
    assert sorted((r.provider_group_id, r.npi) for r in found.collect()) == [("7", "1"), ("7", "2"), ("8", "3")]
    rows = files.fetched_csv(files.fetched(urls.where("url like '%csv'"))).collect()
    assert [r.row for r in rows] == [{"zip_code": "1", "zip_code_2": "é"}, {"zip_code": "2", "zip_code_2": ""}]


def _ask(url, body=None):
    try:
        with urllib.request.urlopen(urllib.request.Request(url, None if body is None else json.dumps(body).encode(), method="POST" if body is not None else "GET")) as answer:
            return answer.status, json.loads(answer.read())
    except urllib.error.HTTPError as e:
        return e.code, json.loads(e.read())


def test_service():
    def convert(request, tell):
        tell("half")
        if request.file_name == "bad":
            raise RuntimeError("no such file")
        return {"rows": 3}

    work = jobs.Jobs(convert)
    server = api.serve(work, port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}/api/v1"
    assert _ask(f"{base}/health") == (200, {"status": "healthy"})
    assert _ask(f"{base}/convert", {})[0] == 400 == _ask(f"{base}/convert", {"plan_name": "a", "file_name": "b"})[0] == _ask(f"{base}/convert", {"plan_name": "a", "zipcode_distance_miles": -1})[0]
    assert _ask(f"{base}/status/none")[0] == 404 == _ask(f"{base}/none")[0]
    ends = {}
    for name in ("good", "bad"):
        code, body = _ask(f"{base}/convert", {"file_name": name, "unknown": 1})
        assert code == 202
        for _ in range(100):
            ends[name] = _ask(f"{base}/status/{body['job_id']}")[1]
            if ends[name]["status"] in ("completed", "failed"):
                break
            time.sleep(0.02)
    assert ends["good"]["result"] == {"rows": 3} and ends["bad"]["error"] == "no such file"
    server.shutdown()
    work.close()


def test_requests_are_resolved(spark):
    catalog = spark.createDataFrame([("a.json", [("p",)]), ("b.json", [("q",), ("p",)]), ("c.json", None)], "file_name string, reporting_plans array<struct<plan_name:string>>")
    places = spark.createDataFrame([("1", "60601"), ("2", "60602"), ("3", "01001")], "NPI string, zipcode string")
    near = spark.createDataFrame([("60601", "60601", 0.0), ("60601", "60602", 4.0)], "zip1 string, zip2 string, distance_miles double")
    of = lambda **more: resolve.resolve(jobs.ConvertRequest(**more), catalog, places, near)
    names = lambda r: sorted(x.file_name for x in r.files.collect())
    npis = lambda r: sorted(x.npi for x in r.request.npis.collect())
    assert names(of(plan_name="p")) == ["a.json", "b.json"] and names(of(file_name="c.json")) == ["c.json"] and of(plan_name="p").request.npis is None
    assert npis(of(plan_name="p", zipcode="60601", zipcode_distance_miles=1)) == ["1"] and npis(of(plan_name="p", zipcode="60601")) == ["1", "2"]
    assert npis(of(plan_name="p", zipcode="99999")) == [] and npis(of(plan_name="p", npi="7, 8", zipcode="60601")) == ["7", "8"]
    assert of(plan_name="p", cpt_code="70010, 70020-70030").request.codes == ["70010", "70020-70030"]


def test_codecs_in_turn(spark, tmp_path):
    df = spark.range(3)
    assert writers.parquet(df, str(tmp_path / "a"), codecs=("none such", "zstd")) == "zstd" and spark.read.parquet(str(tmp_path / "a")).count() == 3
    with pytest.raises(Exception, match="none such"):
        writers.parquet(df, str(tmp_path / "b"), codecs=("none such",))


def test_bulk_load(spark):
    got, fails = [], iter([True])

    class Index(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"])).decode()
            bad = next(fails, False)
            if not bad:
                got.extend(map(json.loads, body.splitlines()))
            self.send_response(503 if bad else 200)
            self.end_headers()
            self.wfile.write(b'{"errors": false}')

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Index)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    docs = writers.search_documents(spark.range(7).selectExpr("id AS k", "concat('n', id) AS name"), "k")
    done = writers.post_bulk(docs.coalesce(1), f"http://127.0.0.1:{server.server_port}/_bulk", "prices", batch=3, wait=0.01).collect()
    assert [(r.sent, r.failed, r.error) for r in done] == [(3, 0, None), (3, 0, None), (1, 0, None)]
    assert {a["index"]["_id"] for a in got[0::2]} == {str(k) for k in range(7)} and {d["name"] for d in got[1::2]} == {f"n{k}" for k in range(7)}
    server.shutdown()
    gone = writers.post_bulk(docs.coalesce(1), "http://127.0.0.1:9/_bulk", "prices", tries=1, wait=0.0).collect()
    assert [(r.sent, r.failed) for r in gone] == [(0, 7)] and gone[0].error


def test_a_batch_asks_only_for_its_own_range(spark, tmp_path):
    from tariffloom.streaming import landing

    spark.range(0, 100).selectExpr("id", "concat('k', id) AS name").write.parquet(str(tmp_path / "t"))
    landed = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([(99, "k99"), (100, "k100"), (100, "k100"), (None, None)], "id long, name string")
    new = landing.unlanded(batch, landed, ["id"])
    assert sorted((r.id or -1) for r in new.collect()) == [-1, 100]
    assert "GreaterThanOrEqual(id,99)" in new._jdf.queryExecution().toString()
    assert landing.unlanded(batch, landed, ["id", "name"]).count() == 2
    assert landing.unlanded(batch.where("id is null"), landed, ["id"]).count() == 1
