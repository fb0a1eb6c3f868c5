"""Loads over HTTP: tasks prepare labelled transactions, the driver commits them all, or takes them back if a task fails.

A label says which task's share of which part of which batch it is. A share that comes again under a label that was committed
is left out; one whose earlier attempt was only prepared is taken back and prepared anew. So a batch that is repeated loads
nothing twice, and one that fails leaves nothing. A search index has no transactions: its documents carry the batch's number as
their version, so what comes again changes nothing and what comes late is refused."""

from __future__ import annotations

import base64
import json
import re
import urllib.error
import urllib.request
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

LABEL = re.compile(r"[^-_A-Za-z0-9]")


class LoadError(Exception):
    pass


class Client:
    """prepare() returns a transaction, or None if its label was committed before."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.options, self.url = options, options["url"].rstrip("/")

    def call(self, method: str, path: str, headers: Mapping[str, str], body: bytes = b"", hops: int = 3) -> dict:
        """An answer's JSON; redirects are followed with the body."""
        url = path if "://" in path else self.url + path
        user = f"{self.options.get('user', '')}:{self.options.get('password', '')}".encode()
        request = urllib.request.Request(url, body, {"Authorization": "Basic " + base64.b64encode(user).decode(), "Expect": "", **headers}, method=method)
        try:
            with urllib.request.urlopen(request, timeout=float(self.options.get("timeout", 600))) as answer:
                return json.loads(answer.read() or b"{}")
        except urllib.error.HTTPError as wrong:
            if wrong.code in (307, 308) and hops:
                return self.call(method, wrong.headers["Location"], headers, body, hops - 1)
            raise LoadError(f"{method} {path}: {wrong.code} {wrong.read()[:300]!r}") from wrong
        except (urllib.error.URLError, ValueError) as wrong:
            raise LoadError(f"{method} {path}: {wrong}") from wrong

    def prepare(self, label: str, lines: list[str]) -> str | None:
        raise NotImplementedError

    def commit(self, label: str, txn: str) -> None:
        pass

    def abort(self, label: str, txn: str) -> None:
        pass


class Doris(Client):
    """Stream loads in two phases."""

    def prepare(self, label: str, lines: list[str]) -> str | None:
        place = f"/api/{self.options['database']}/{self.options['table']}/_stream_load"
        headers = {"label": label, "format": "json", "read_json_by_line": "true", "two_phase_commit": "true", "hidden_columns": "__DORIS_DELETE_SIGN__", "max_filter_ratio": "0"}
        for _ in range(2):
            told = self.call("PUT", place, headers, "\n".join(lines).encode())
            if told.get("Status") == "Success":
                return str(told["TxnId"])
            if told.get("Status") != "Label Already Exists":
                break
            if told.get("ExistingJobStatus") in ("FINISHED", "COMMITTED", "VISIBLE"):
                return None
            self.finish(label, "abort")
        raise LoadError(f"{label}: {told.get('Message') or told}")

    def finish(self, label: str, what: str) -> None:
        told = self.call("PUT", f"/api/{self.options['database']}/_stream_load_2pc", {"label": label, "txn_operation": what})
        if str(told.get("status", told.get("Status"))).lower() != "success":
            raise LoadError(f"{what} {label}: {told}")

    def commit(self, label: str, txn: str) -> None:
        self.finish(label, "commit")

    def abort(self, label: str, txn: str) -> None:
        self.finish(label, "abort")


class StarRocks(Client):
    """Transactions of begin, load, prepare and commit."""

    def step(self, what: str, label: str, body: bytes = b"") -> dict:
        headers = {"label": label, "db": self.options["database"], "table": self.options["table"], "format": "json", "max_filter_ratio": "0"}
        return self.call("PUT" if what == "load" else "POST", f"/api/transaction/{what}", headers, body)

    def prepare(self, label: str, lines: list[str]) -> str | None:
        told = self.step("begin", label)
        if told.get("Status") == "LABEL_ALREADY_EXISTS":
            if told.get("ExistingJobStatus") in ("FINISHED", "COMMITTED", "VISIBLE"):
                return None
            self.step("rollback", label)
            told = self.step("begin", label)
        for what, body in ((None, b""), ("load", ("\n".join(lines)).encode()), ("prepare", b"")):
            told = told if what is None else self.step(what, label, body)
            if told.get("Status") != "OK":
                raise LoadError(f"{label}: {told.get('Message') or told}")
        return label

    def commit(self, label: str, txn: str) -> None:
        told = self.step("commit", label)
        if told.get("Status") != "OK":
            raise LoadError(f"commit {label}: {told}")

    def abort(self, label: str, txn: str) -> None:
        self.step("rollback", label)


class Elasticsearch(Client):
    """Bulk requests of versioned documents."""

    def prepare(self, label: str, lines: list[str]) -> str | None:
        told = self.call("POST", "/_bulk", {"Content-Type": "application/x-ndjson"}, ("\n".join(lines) + "\n").encode())
        for item in told.get("items", []) if told.get("errors") else []:
            (kind, one), = item.items()
            if one.get("status", 200) >= 300 and not (kind == "delete" and one["status"] == 404) and one["status"] != 409:
                raise LoadError(f"{kind} {one.get('_id')}: {one.get('error')}")
        return None


CLIENTS = {"doris": Doris, "starrocks": StarRocks, "elasticsearch": Elasticsearch}


@dataclass
class Prepared(WriterCommitMessage):
    #: (label, transaction)
    transactions: list[tuple[str, str]] = field(default_factory=list)


class Loads(DataSource):
    """Format deltaloom-load for rows (value), a line of a load each; options kind, url, database, table, label, user, password,
    bytes (of one load)."""

    @classmethod
    def name(cls) -> str:
        return "deltaloom-load"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return LoadWriter(dict(self.options))


class LoadWriter(DataSourceWriter):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.options = options

    def client(self) -> Client:
        return CLIENTS[self.options["kind"]](self.options)

    def write(self, iterator: Iterator[Row]) -> Prepared:
        client, out, lines, size = self.client(), Prepared(), [], 0
        most, share = int(self.options.get("bytes", 64 << 20)), TaskContext.get().partitionId()

        def send() -> None:
            label = f"{self.options['label']}-{share}-{number}"
            txn = client.prepare(label, lines)
            if txn is not None:
                out.transactions.append((label, txn))

        number = 0
        try:
            for row in iterator:
                lines.append(row[0])
                size += len(row[0])
                if size >= most:
                    send()
                    number, lines, size = number + 1, [], 0
            if lines:
                send()
        except BaseException:
            take_back(client, out)
            raise
        return out

    def commit(self, messages: list[Prepared | None]) -> None:
        client = self.client()
        for message in messages:
            for label, txn in message.transactions if message else []:
                client.commit(label, txn)

    def abort(self, messages: list[Prepared | None]) -> None:
        client = self.client()
        for message in messages:
            if message:
                take_back(client, message)


def take_back(client: Client, message: Prepared) -> None:
    for label, txn in message.transactions:
        try:
            client.abort(label, txn)
        except LoadError:  # it times out there
            continue


def label_of(*parts: object) -> str:
    """A label of the letters that labels may have; what is left out is told apart by a checksum."""
    text = "-".join(map(str, parts))
    return f"{LABEL.sub('_', text)[-80:]}-{zlib.crc32(text.encode()):08x}"


__all__ = ["CLIENTS", "LoadError", "Loads", "label_of"]
