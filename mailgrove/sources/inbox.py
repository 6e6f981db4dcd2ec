"""Git mail inboxes and news servers as Python data sources: one partition an epoch or a range of articles."""

from __future__ import annotations

import os
import re
import socket
import ssl
import subprocess
import time
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "list string, email_id string, content binary, position long, error string"


def _git(repo: str, *args: str, data: bytes | None = None) -> bytes:
    return subprocess.run(["git", "--git-dir", repo, *args], input=data, capture_output=True, check=True).stdout


def epochs(inbox: str) -> list[tuple[str, str]]:
    """(epoch, repository) in order, `all` last: numbered repositories below git/, else the inbox itself."""
    many = os.path.join(inbox, "git")
    if os.path.isdir(many):
        names = [n[:-4] for n in os.listdir(many) if n.endswith(".git") and os.path.isdir(os.path.join(many, n, "objects"))]
        return [(n, os.path.join(many, f"{n}.git")) for n in sorted(names, key=lambda n: (not n.isdigit(), int(n) if n.isdigit() else 0))]
    for repo in (os.path.join(inbox, "all.git"), os.path.join(inbox, ".git"), inbox):
        if os.path.isdir(os.path.join(repo, "objects")):
            return [("all", repo)]
    return []


def kind_of(inbox: str) -> str:
    """V2, V1, or either with (empty) when there is no commit."""
    found = epochs(inbox)
    if not found:
        return "none"
    kind = "V2" if os.path.isdir(os.path.join(inbox, "git")) else "V1"
    return kind if any(commits(repo) for _, repo in found) else f"{kind} (empty)"


def commits(repo: str, after: str | None = None) -> list[str]:
    """Commits oldest first; after: only those that follow it."""
    try:
        return _git(repo, "rev-list", "--reverse", f"{after}..HEAD" if after else "HEAD").decode().split()
    except subprocess.CalledProcessError:
        return []


def messages(repo: str, shas: list[str]) -> Iterator[tuple[str, bytes | None]]:
    """The blob `m` of each commit, from one git process; None where it is missing."""
    with subprocess.Popen(["git", "--git-dir", repo, "cat-file", "--batch"], stdin=subprocess.PIPE, stdout=subprocess.PIPE) as git:
        for sha in shas:
            git.stdin.write(f"{sha}:m\n".encode())
            git.stdin.flush()
            head = git.stdout.readline().split()
            if head[-1:] == [b"missing"] or len(head) < 3:
                yield sha, None
                continue
            data = git.stdout.read(int(head[2]))
            git.stdout.read(1)
            yield sha, data
        git.stdin.close()


class EpochPartition(InputPartition):
    def __init__(self, name, epoch, repo, first):
        self.name, self.epoch, self.repo, self.first = name, epoch, repo, first


class InboxReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].removeprefix("file://")
        self.name = options.get("list") or os.path.basename(self.path.rstrip("/"))

    def partitions(self):
        out, first = [], 1
        for epoch, repo in epochs(self.path):
            out.append(EpochPartition(self.name, epoch, repo, first))
            first += len(commits(repo))
        return out

    def read(self, partition):
        shas = commits(partition.repo)
        for i, (sha, data) in enumerate(messages(partition.repo, shas)):
            position = partition.first + i
            yield partition.name, f"{position:010d}-e{partition.epoch}-{sha}", data, position, None if data is not None else "no message in commit"


class InboxSource(DataSource):
    """format("git_inbox"): path, list. Filter on position or email_id to read single messages."""

    @classmethod
    def name(cls):
        return "git_inbox"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return InboxReader(self.options)


class NewsClient:
    """The few commands of the news protocol that reading needs."""

    def __init__(self, host: str, port: int = 119, secure: bool = False, user: str | None = None, password: str | None = None, timeout: float = 30):
        sock = socket.create_connection((host, port), timeout)
        self.sock = ssl.create_default_context().wrap_socket(sock, server_hostname=host) if secure else sock
        self.file = self.sock.makefile("rb")
        self._reply()
        self.command("MODE READER")
        if user and self.command(f"AUTHINFO USER {user}")[0] == 381:
            self.command(f"AUTHINFO PASS {password}")

    def _reply(self) -> tuple[int, str]:
        line = self.file.readline().decode("utf-8", "replace").strip()
        return int(line[:3]) if line[:3].isdigit() else 0, line[4:]

    def command(self, text: str) -> tuple[int, str]:
        self.sock.sendall(text.encode() + b"\r\n")
        return self._reply()

    def lines(self) -> list[bytes]:
        out = []
        while (line := self.file.readline()) not in (b".\r\n", b".\n", b""):
            out.append(line[1:] if line.startswith(b"..") else line)
        return out

    def groups(self) -> list[str]:
        return [x.split()[0].decode() for x in self.lines() if x.split()] if self.command("LIST")[0] == 215 else []

    def group(self, name: str) -> tuple[int, int] | None:
        """(low, high)."""
        code, text = self.command(f"GROUP {name}")
        return (int(text.split()[1]), int(text.split()[2])) if code == 211 else None

    def article(self, number: int) -> bytes | None:
        """None when the server says that there is none."""
        code, text = self.command(f"ARTICLE {number}")
        if code == 220:
            return b"".join(self.lines())
        if code in (420, 423, 430):
            return None
        raise OSError(f"{code} {text}")

    def close(self) -> None:
        self.sock.close()


class RangePartition(InputPartition):
    def __init__(self, group, low, high):
        self.group, self.low, self.high = group, low, high


class NewsReader(DataSourceReader):
    STEP, TRIES, WAIT = 1000, 3, 0.6

    def __init__(self, options):
        self.options = dict(options)

    def client(self):
        o = self.options
        return NewsClient(o["host"], int(o.get("port", 119)), o.get("secure", "false") == "true", o.get("user"), o.get("password"))

    def partitions(self):
        client, out = self.client(), []
        names = [x for x in self.options.get("groups", "").split(",") if x] or client.groups()
        after = int(self.options.get("after", 0))  # the last article that was read; it is not read again
        for name in names:
            if span := client.group(name):
                low, high = max(span[0], after + 1), span[1]
                out += [RangePartition(name, a, min(a + self.STEP - 1, high)) for a in range(low, high + 1, self.STEP)]
        client.close()
        return out or [RangePartition("", 1, 0)]

    def read(self, partition):
        if partition.high < partition.low:
            return
        client = self.client()
        client.group(partition.group)
        for number in range(partition.low, partition.high + 1):
            data, error = None, "unavailable"
            for attempt in range(self.TRIES + 1):
                try:
                    data = client.article(number)
                    error = None if data is not None else "unavailable"
                    break
                except OSError as e:
                    error = str(e)
                    if attempt < self.TRIES:
                        time.sleep(self.WAIT * (attempt + 1))
                        client = self.client()
                        client.group(partition.group)
            yield partition.group, str(number), data, number, error
        client.close()


class NewsSource(DataSource):
    """format("news"): host, port, secure, user, password, groups (comma list), after."""

    @classmethod
    def name(cls):
        return "news"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return NewsReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(InboxSource)
    spark.dataSource.register(NewsSource)


def list_name_of(email_id: str) -> str | None:
    """The epoch an identifier names."""
    m = re.match(r"^\d{10}-e([^-]+)-", email_id)
    return m[1] if m else None
