"""Parsing, domain functions, sources and sinks."""

import socketserver
import subprocess
import threading
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from mailgrove.functions import addresses, dates, extract, identity, ids
from mailgrove.operators import parse as P
from mailgrove.operators.mime import parse_message
from mailgrove.sources import archive, inbox

NOW = datetime.fromtimestamp(1779062556, UTC)
NOW_MICROS = 1779062556_000_000
MAIL = b"""From: =?utf-8?q?B=C3=A9a_One?= <bea@one.example>\r
To: "Two, Tim" <tim@two.example>, dev@lists.example\r
Subject: [PATCH] a long\r
 subject\r
a malformed line\r
Message-ID: <m1@one.example>\r
References: <r1@x.example> <r2@x.example>\r
Date: Mon, 03 Jan 2022 10:00:00 +0100\r
Content-Type: text/plain; charset=iso-8859-1\r
Content-Transfer-Encoding: quoted-printable\r
\r
Gr=FC=DFe\r
\r
Reviewed-by: Ann Bee <ann@bee.example>\r
---\r
 f.c | 1 +\r
diff --git a/f.c b/f.c\r
+x\r
"""


def test_message_fields():
    m = parse_message(MAIL, NOW)
    assert m["from"] == "Béa One <bea@one.example>" and m["to"] == ["Two Tim <tim@two.example>", "dev@lists.example"]
    assert m["subject"] == "[PATCH] a long subject" and m["message_id"] == "m1@one.example" and m["references"] == ["r1@x.example", "r2@x.example"]
    assert m["cc"] is None and m["in_reply_to"] is None and m["raw_body"].startswith("Grüße\n")
    assert m["date_options"] == [int(datetime(2022, 1, 3, 9, tzinfo=UTC).timestamp()) * 1_000_000]


@pytest.mark.parametrize("text", [b"", b"\n\nbody", b"no colon here\n\nx", b"From: a@b.cc\nContent-Type: multipart/mixed; boundary=q\n\n--q\n"])
def test_broken_messages_never_raise(text):
    assert set(parse_message(text, NOW)) >= {"error", "from"}


def test_parse_dataset_and_errors(spark, tmp_path):
    for name, data in (("1", MAIL), ("2", b"\n")):
        (tmp_path / "in/alpha").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"in/alpha/{name}.eml").write_bytes(data)
    raw = archive.read_eml(spark, f"file://{tmp_path}/in")
    parsed = P.parse(raw, NOW_MICROS)
    P.write_dataset(parsed, f"file://{tmp_path}/out")
    row = spark.read.parquet(f"file://{tmp_path}/out/dataset").first()
    assert row["list"] == "alpha" and row["__file_name"] == "1" and str(row["date"]) == "2022-01-03 09:00:00"
    assert [tuple(t) for t in row["trailers"]] == [("Reviewed-by", "Ann Bee <ann@bee.example>")]
    assert len(row["code"]) == 1 and row["code"][0].startswith("---") and row["cc"] is None
    assert spark.read.csv(f"file://{tmp_path}/out/errors").first()[0] == "2"
    P.write_pseudonymised(spark.read.parquet(f"file://{tmp_path}/out/dataset"), f"file://{tmp_path}/anon")
    anon = spark.read.parquet(f"file://{tmp_path}/anon/dataset").first()
    assert "bea@one" not in anon["from"] and "ann@bee" not in anon["raw_body"] and anon["subject"] == row["subject"]


def test_archive_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "1", b"x: y\n\nz")], "list string, email_id string, content binary")
    archive.write_archive(df, f"file://{tmp_path}/raw")
    got = archive.read_archives(spark, f"file://{tmp_path}/raw").first()
    assert (got["list"], got["email_id"], bytes(got["content"])) == ("a", "1", b"x: y\n\nz")


def test_lineage(spark):
    text = "email_index: 7\nlist_name: a\narchive_timestamp: 2025-01-15T10:30:00+00:00\n---\nlist_name: b\narchive_timestamp: never\n---\n\n"
    rows = P.lineage(spark.createDataFrame([(text,)], "value string"), "2026-01-01 00:00:00", "v1").collect()
    assert len(rows) == 2 and str(rows[0]["archive_timestamp"]) == "2025-01-15 10:30:00" and rows[1]["archive_timestamp"] is None and rows[1]["email_index"] == ""


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Jean-Luc P <jean (a) fleet.sf>", "Jean-Luc P <jean@fleet.sf>"),
        ("jean at fleet.sf", "jean@fleet.sf"),
        ("Will R will@fleet.sf", "Will R <will@fleet.sf>"),
        ("Will <r.wfleet.sf>", "Will <r.@wfleet.sf>"),
        ("nobody", "nobody"),
        ("  a@b.cc ", "a@b.cc"),
    ],
)
def test_addresses(spark, text, want):
    assert addresses.normalize(text) == want
    assert spark.createDataFrame([(text,)], "a string").select(addresses.normalize_address(F.col("a"))).first()[0] == want


def test_commas_in_names():
    assert addresses.join_split_names(["La Forge", "Geordi <g@fleet.sf>", "x@y.zz"]) == ["La Forge Geordi <g@fleet.sf>", "x@y.zz"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Mon, 3 Jan 78 18:27:37", "1978-01-03 18:27:37"),
        ("Mon, 3 Jan 100 18:27:37", "2000-01-03 18:27:37"),
        ("Mon, 3 Jan 0120 18:27:37 -0400", "2020-01-03 22:27:37"),
        ("99-12-31T23:59:59Z", "1999-12-31 23:59:59"),
        ("101-06-15T16:30:00-07:00", "2001-06-15 23:30:00"),
        ("Thu, 5 Jun 2008 10:00:00 +9900", None),
        ("nothing", None),
        ("3 Jan 00 10:00:00 +0100", "2000-01-03 09:00:00"),
        ("Fri, 1 Jun 22 14:30", "2022-06-01 14:30:00"),
        ("Mon, 15 Mar 2021 10:30 UT", "2021-03-15 10:30:00"),
        ("01 Jul 2021 12:00:00 A", "2021-07-01 12:00:00"),
        ("Wed, 15 Jan 2025 08:30:00 EST", "2025-01-15 13:30:00"),
        ("Thu Oct 16 22:10:38 EST 2008", "2008-10-16 22:10:38"),
        ("31-Oct-2005 11:20:23 MST", "2005-10-31 11:20:23"),
        ("Sunday, 06-Nov-94 08:49:37 GMT", "1994-11-06 08:49:37"),
        ("Thu Jul 10 13:45:50 2008 -0500", "2008-07-10 18:45:50"),
        ("Sun Nov  6 08:49:37 1994", "1994-11-06 08:49:37"),
        ("2006-07-19 16:56:33 -0700 (Wed, 19 Jul 2006)", "2006-07-19 23:56:33"),
        ("at 2025-12-05T11:13:54.250-06:00 sharp", "2025-12-05 17:13:54"),
        ("0102-08-22 10:00:00Z", "2002-08-22 10:00:00"),
        ("Tue,  4 Nov 101 22:14:47 +0000 (UTC)", "2001-11-04 22:14:47"),
        ("Tue, 31 Nov 2006 10:06:43 +0300", None),
        ("Mon, 15 Apr 2024 10:00:00 +2400", None),
        ("Mon, 15 Apr 2024 10:00:00 +2359", "2024-04-14 10:01:00"),
        ("Sat, 31 Dec 2022 23:59:60 -0000", "2022-12-31 23:59:59"),
        ("29 Feb 2023 10:00:00 GMT", None),
    ],
)
def test_dates(text, want):
    got = dates.parse_micros(text, NOW)
    assert (None if got is None else str(datetime.fromtimestamp(got / 1e6, UTC))[:19]) == want


def test_select_date(spark):
    day = 86_400_000_000
    base = int(datetime(2010, 1, 1, tzinfo=UTC).timestamp()) * 1_000_000
    cases = [([], None), ([0], None), ([base], base), ([base + day * 9, base], base), ([base - day * 2000, base, base + 1, base + 2, base + 5], base), ([NOW_MICROS + 10 * day, base], base)]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, c array<bigint>")
    got = {r["i"]: r["d"] for r in df.select("i", dates.select_date(F.col("c"), F.lit(NOW_MICROS)).alias("d")).collect()}
    assert got == {i: w for i, (_, w) in enumerate(cases)}


def test_extractors(spark):
    body = "x\nReviewed-by: A B\n<a@b.cc>\nFixes: abc\n-- \nTested-by: N <n@n.nn>"
    df = spark.createDataFrame([(body, "a\n---\ndiff --git x\n---\nrest"), ("", "none")], "b string, p string")
    rows = df.select(extract.trailers(F.col("b")).alias("t"), extract.patches(F.col("p")).alias("p")).collect()
    assert [tuple(t) for t in rows[0]["t"]] == [("Reviewed-by", "A B <a@b.cc>")] and rows[0]["p"] == ["---\ndiff --git x"]
    assert rows[1]["t"] == [] and rows[1]["p"] is None


def test_pseudonyms(spark):
    h = identity._digest
    assert identity.pseudonymise_text("From: A B <a@b.cc>") == f"From: {h('A B')} <{h('a@b.cc')}>"
    assert identity.pseudonymise_text("A B a@b.cc") == f"{h('A B')} <{h('a@b.cc')}>"
    assert identity.pseudonymise_text("x\na@b.cc") == "x\na@b.cc" and identity.pseudonymise_text("x\na@b.cc", strict=True) == f"x\n{h('a@b.cc')}"
    df = spark.createDataFrame([(None, ["q@r.ss", None], None), ("t", None, [("Acked-by", "N <n@o.pp>")])], "raw_body string, cc array<string>, trailers array<struct<attribution:string,identification:string>>")
    a, b = identity.pseudonymise_frame(df).collect()
    assert a["cc"] == [h("q@r.ss"), ""] and a["raw_body"] is None and a["trailers"] == [] and b["cc"] is None and b["trailers"][0]["attribution"] == "Acked-by"


def test_identifiers_and_ranges(spark):
    assert ids.parse_ranges("1, 3-5,10") == [(1, 1), (3, 5), (10, 10)]
    for bad in ("", "1,,2", "a", "5-3", "1-2-3"):
        with pytest.raises(ValueError):
            ids.parse_ranges(bad)
    assert ids.expand_globs(["net*", "bpf", "n*", "zz"], ["netdev", "bpf", "nfs"]) == (["netdev", "bpf", "nfs"], ["zz"])
    assert ids.parse_write_mode("parquet_500") == ("parquet", 500) and ids.parse_write_mode("raw") == ("raw", None)


def test_git_inbox(spark, tmp_path):
    repo = tmp_path / "box/git/0.git"
    work = tmp_path / "work"
    run = lambda *a, **k: subprocess.run(["git", *a], check=True, capture_output=True, cwd=k.get("cwd"))
    run("init", "-q", str(work))
    for i in range(3):
        (work / "m").write_bytes(b"Subject: %d\n\nx" % i)
        run("add", "m", cwd=work)
        run("-c", "user.name=n", "-c", "user.email=e@e.ee", "commit", "-qm", str(i), cwd=work)
    repo.parent.mkdir(parents=True)
    run("clone", "-q", "--bare", str(work), str(repo))
    inbox.register(spark)
    rows = spark.read.format("git_inbox").option("path", str(tmp_path / "box")).load().orderBy("position").collect()
    assert [r["position"] for r in rows] == [1, 2, 3] and bytes(rows[2]["content"]) == b"Subject: 2\n\nx" and rows[0]["email_id"].startswith("0000000001-e0-")
    assert inbox.kind_of(str(tmp_path / "box")) == "V2"


def test_news_source(spark):
    class Server(socketserver.StreamRequestHandler):
        def handle(self):
            self.wfile.write(b"200 hi\r\n")
            for line in self.rfile:
                word = line.split()
                if word[0] == b"GROUP":
                    self.wfile.write(b"211 3 1 3 g\r\n")
                elif word[0] == b"ARTICLE":
                    self.wfile.write(b"423 none\r\n" if word[1] == b"2" else b"220 ok\r\nSubject: s\r\n\r\n..dot\r\n.\r\n")
                else:
                    self.wfile.write(b"200 ok\r\n")

    with socketserver.ThreadingTCPServer(("127.0.0.1", 0), Server) as server:
        server.daemon_threads = True
        threading.Thread(target=server.serve_forever, daemon=True).start()
        inbox.register(spark)
        rows = spark.read.format("news").option("host", "127.0.0.1").option("port", server.server_address[1]).option("groups", "g").load().orderBy("position").collect()
        server.shutdown()
    assert [r["error"] for r in rows] == [None, "unavailable", None] and bytes(rows[0]["content"]).endswith(b"\r\n.dot\r\n")


def test_sql_functions(spark):
    from mailgrove.functions.registry import register

    register(spark)
    assert spark.sql("SELECT normalize_address('a at b.cc') AS x").first()["x"] == "a@b.cc"
    assert spark.sql("SELECT * FROM trailers_of('Acked-by: A <a@b.cc>')").first()["identification"] == "A <a@b.cc>"
