"""Loads over HTTP against a server that keeps labels, transactions and versions as the databases do."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from deltaloom.catalog import Schema, TableId
from deltaloom.sinks.registry import open_sink
from deltaloom.sources.registry import open_source

TABLE = TableId.parse("shop.items")
KEYED, LOOSE = Schema.of(("id", "BIGINT"), ("name", "STRING"), keys=["id"]), Schema.of(("id", "BIGINT"), ("name", "STRING"))


class Server(ThreadingHTTPServer):
    def __init__(self):
        super().__init__(("127.0.0.1", 0), Handler)
        self.prepared, self.finished, self.documents, self.refuse, self.commits, self.lock = {}, {}, {}, None, 0, threading.Lock()
        threading.Thread(target=self.serve_forever, daemon=True).start()

    @property
    def url(self):
        return f"http://127.0.0.1:{self.server_port}"

    def rows(self):
        return sorted(((r["id"], r["name"], r.get("__op", r.get("__DORIS_DELETE_SIGN__"))) for own in self.finished.values() for r in own), key=str)


class Handler(BaseHTTPRequestHandler):
    def log_message(self, *_):
        pass

    def answer(self, told, code=200, **headers):
        self.send_response(code)
        for name, value in headers.items():
            self.send_header(name, value)
        body = json.dumps(told).encode()
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def do_PUT(self):  # noqa: N802
        body, label, own = self.rfile.read(int(self.headers.get("Content-Length") or 0)).decode(), self.headers["label"], self.server
        with own.lock:
            if self.path.endswith("/_stream_load"):
                return self.answer({}, 307, Location=f"{own.url}{self.path}_there")  # a frontend sends on to a backend
            if self.path.endswith("/_stream_load_there"):
                if label in own.finished or label in own.prepared:
                    return self.answer({"Status": "Label Already Exists", "ExistingJobStatus": "FINISHED" if label in own.finished else "PRECOMMITTED"})
                if own.refuse and own.refuse in body:
                    return self.answer({"Status": "Fail", "Message": "too many filtered rows"})
                own.prepared[label] = [json.loads(x) for x in body.split("\n")]
                return self.answer({"Status": "Success", "TxnId": len(own.prepared)})
            if self.path.endswith("/_stream_load_2pc"):
                return self.finish(label, self.headers["txn_operation"], {"status": "Success"})
            if self.path == "/api/transaction/load":
                if own.refuse and own.refuse in body:
                    return self.answer({"Status": "INTERNAL_ERROR", "Message": "type mismatch"})
                own.prepared[label] = [json.loads(x) for x in body.split("\n")]
                return self.answer({"Status": "OK"})

    def finish(self, label, what, good):
        own = self.server
        if what == "commit":
            own.commits += 1
            if own.commits == own.refuse_commit:
                return self.answer({"Status": "Fail", "status": "Fail"})
            own.finished[label] = own.prepared.pop(label)
        else:
            own.prepared.pop(label, None)
        return self.answer(good)

    def do_POST(self):  # noqa: N802
        body, label, own = self.rfile.read(int(self.headers.get("Content-Length") or 0)).decode(), self.headers["label"], self.server
        with own.lock:
            step = self.path.rsplit("/", 1)[-1]
            if step == "begin":
                if label in own.finished or label in own.prepared:
                    return self.answer({"Status": "LABEL_ALREADY_EXISTS", "ExistingJobStatus": "FINISHED" if label in own.finished else "PREPARED"})
                own.prepared[label] = []
                return self.answer({"Status": "OK"})
            if step == "prepare":
                return self.answer({"Status": "OK"})
            if step in ("commit", "rollback"):
                return self.finish(label, step, {"Status": "OK"})
            lines, items = [json.loads(x) for x in body.strip().split("\n")], []
            while lines:
                (kind, head), = lines.pop(0).items()
                document = lines.pop(0) if kind == "index" else None
                key = (head["_index"], head["_id"])
                if own.refuse and document and own.refuse in json.dumps(document):
                    items.append({kind: {"_id": head["_id"], "status": 400, "error": "mapping"}})
                elif head["version"] < own.documents.get(key, (0, None))[0]:
                    items.append({kind: {"_id": head["_id"], "status": 409, "error": "conflict"}})
                else:
                    own.documents[key] = (head["version"], document)
                    items.append({kind: {"_id": head["_id"], "status": 200}})
            self.answer({"errors": any(next(iter(i.values()))["status"] >= 300 for i in items), "items": items})


@pytest.fixture
def server():
    made = Server()
    made.refuse_commit = None
    yield made
    made.shutdown()
    made.server_close()


def changes(spark, *rows):
    events = [{"table": str(TABLE), "schema": [["id", "BIGINT"], ["name", "STRING"]], "keys": ["id"], "rows": [list(r) for r in rows]}]
    return open_source(spark, {"type": "values", "events": events}).tables[TABLE]


def inserts(*ids):
    return [("INSERT", None, [i, f"n{i}"]) for i in ids]


@pytest.mark.parametrize("kind", ["doris", "starrocks"])
def test_labelled_loads(spark, server, kind):
    sink = open_sink(spark, {"type": kind, "load.url": server.url, "user": "u", "password": "p", "sink.parallelism": 3, "sink.buffer-flush.max-bytes": 60})
    sink.writer = "cp"
    sink.write(TABLE, changes(spark, *inserts(*range(12)), ("DELETE", [3, "n3"], None)), KEYED, 0)
    first = [(i, f"n{i}", 0) for i in range(12) if i != 3] + [(3, None, 1)]
    assert server.rows() == sorted(first, key=str) and not server.prepared and len(server.finished) > 3
    sink.write(TABLE, changes(spark, *inserts(*range(12)), ("DELETE", [3, "n3"], None)), KEYED, 0)  # again
    assert server.rows() == sorted(first, key=str) and not server.prepared
    # a line that is refused fails its task, and what other tasks have prepared is taken back
    server.refuse = "n17"
    with pytest.raises(Exception, match="filtered|mismatch"):
        sink.write(TABLE, changes(spark, *inserts(*range(12, 24))), LOOSE, 1)
    assert server.rows() == sorted(first, key=str) and not [r for own in server.prepared.values() for r in own]
    # a driver that dies between commits: the batch comes again, rows of a table without a key too
    server.refuse, server.refuse_commit, server.commits = None, 2, 0
    with pytest.raises(Exception, match="commit"):
        sink.write(TABLE, changes(spark, *inserts(*range(12, 24))), LOOSE, 1)
    assert len(server.rows()) > len(first)
    sink.write(TABLE, changes(spark, *inserts(*range(12, 24))), LOOSE, 1)
    assert server.rows() == sorted(first + [(i, f"n{i}", 0) for i in range(12, 24)], key=str) and not server.prepared


def test_versioned_documents(spark, server):
    sink = open_sink(spark, {"type": "elasticsearch", "load.url": server.url, "index": "items"})
    sink.writer = "cp"
    read = lambda: {k[1]: d["name"] for k, (_, d) in server.documents.items() if d}
    sink.write(TABLE, changes(spark, *inserts(1, 2, 3)), KEYED, 0)
    sink.write(TABLE, changes(spark, ("UPDATE", [1, "n1"], [1, "x"]), ("DELETE", [2, "n2"], None)), KEYED, 1)
    assert read() == {"1": "x", "3": "n3"}
    sink.write(TABLE, changes(spark, *inserts(1, 2, 3)), KEYED, 0)  # an old batch comes late
    assert read() == {"1": "x", "3": "n3"}
    server.refuse = "bad"
    with pytest.raises(Exception, match="mapping"):
        sink.write(TABLE, changes(spark, ("INSERT", None, [9, "bad"])), KEYED, 2)


def test_a_server_that_is_not_there(spark):
    sink = open_sink(spark, {"type": "doris", "load.url": "http://127.0.0.1:9", "sink.parallelism": 1})
    with pytest.raises(Exception, match="stream_load"):
        sink.write(TABLE, changes(spark, *inserts(1)), KEYED, 0)


def test_buckets_of_a_sink(spark):
    sink = open_sink(spark, {"type": "fluss", "bucket.key": "shop.items:id,name; shop.bad:name", "bucket.num": "shop.items:4"})
    both = Schema.of(("id", "BIGINT"), ("name", "STRING"), keys=["id", "name"])
    assert sink.bucket_keys(TABLE, both) == ["id", "name"] and sink.bucket_keys(TableId.parse("shop.more"), both) == ["id", "name"]
    with pytest.raises(ValueError, match="must be of"):
        sink.bucket_keys(TableId.parse("shop.bad"), KEYED)
    assert sink.bucket_keys(TableId.parse("shop.more"), LOOSE) == []
    rows = spark.range(100).selectExpr("id", "cast(id as string) as name")
    assert sink.dealt(TABLE, rows, both).rdd.getNumPartitions() == 4
    assert sink.dealt(TableId.parse("shop.more"), rows, LOOSE).count() == 100
