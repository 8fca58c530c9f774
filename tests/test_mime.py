"""Hand-made raw mails and what is read from them."""

from __future__ import annotations

import base64
import datetime as dt

import pytest
from pyspark.sql import functions as F

from mailloom import FetchOptions
from mailloom.functions.attributes import attachment_attributes
from mailloom.operators.attachments import attachments, explode_parts, is_attachment, with_parent
from mailloom.operators.project import project_headers
from mailloom.plans.fetch import fetch
from mailloom.schema import RAW
from mailloom.sources.ingest import errors, ingest, parts
from mailloom.sources.mime import MimeFault, addresses, decode_body, decode_words, parse_mail

UTC = dt.timezone.utc

SIMPLE = b"""From: ines@harbour.example
To: crew@harbour.example
Subject: Tide table for Friday
Date: Thu, 7 Mar 2024 06:15:00 +0000
Message-ID: <tide-0307@harbour.example>

See you at two.
"""

INVOICE = b"""From: bakery@mill.example
To: orders@inn.example
Subject: Bread bill of week 11
Date: Fri, 15 Mar 2024 17:45:00 +0000
Message-ID: <bill-11@mill.example>
MIME-Version: 1.0
Content-Type: multipart/mixed; boundary="cut"

--cut
Content-Type: text/plain; charset=UTF-8

The invoice is attached.

--cut
Content-Type: text/plain; charset=UTF-8
Content-Disposition: attachment; filename="invoice.txt"

Total: 100

--cut--"""

NEWSLETTER = b"""From: choir@valley.example
To: friends@valley.example
Subject: Songs we practise in spring
Date: Sun, 24 Mar 2024 20:05:00 +0000
Message-ID: <spring-songs@valley.example>
Content-Type: multipart/alternative; boundary="cut"

--cut
Content-Type: text/plain

News.
--cut
Content-Type: text/html

<p>News.</p>
--cut--
"""

NESTED = b"""From: =?utf-8?q?J=C3=B6rg?= <joerg@example.com>
Subject: =?utf-8?b?R3LDvMOfZQ==?=
Message-ID: <nested@example.com>
Content-Type: multipart/mixed; boundary=outer

preamble is skipped
--outer
Content-Type: multipart/related; boundary=outerinner

--outerinner
Content-Type: image/png
Content-Disposition: inline; filename=logo.png

png
--outerinner
Content-Type: application/pdf; name="=?utf-8?q?b=C3=A9ta=2Epdf?="
Content-Transfer-Encoding: base64

""" + base64.b64encode(b"pdf bytes") + b"""
--outerinner--
--outer
Content-Type: message/rfc822
Content-Disposition: attachment

Subject: inside
Content-Type: multipart/mixed; boundary=deep

--deep
Content-Disposition: attachment; filename=hidden.txt

hidden
--deep--
--outer
Content-Disposition: ATTACHMENT; filename="big.bin"

0123456789012345678901234567890123456789
--outer
content-disposition: Attachment

nameless
--outer--
epilogue is skipped
"""

FAULTY = b"""From: a@example.com
Content-Type: multipart/mixed; boundary=cut

--cut
Content-Disposition: attachment; filename=good.txt

good
--cut
Content-Disposition: attachment; filename=bad.bin
Content-Transfer-Encoding: base64

QUJD QQ
--cut
Content-Disposition: attachment; filename=after.txt

after
--cut--
"""

NO_BOUNDARY = b"Content-Type: multipart/mixed\n\nno parts here\n"


@pytest.fixture(scope="module")
def mails(spark):
    raws = [SIMPLE, INVOICE, NEWSLETTER, NESTED, FAULTY, NO_BOUNDARY]
    stamp = dt.datetime(2024, 2, 1, tzinfo=UTC)
    landed = spark.createDataFrame(
        [("INBOX", n, stamp, len(raw), bytearray(raw)) for n, raw in enumerate(raws, start=1)], RAW
    )
    return ingest(landed).cache()


def test_headers(mails):
    rows = project_headers(mails).orderBy("uid").collect()
    assert [(r.sender, r.to_addr, r.subject) for r in rows[:3]] == [
        ("ines@harbour.example", "crew@harbour.example", "Tide table for Friday"),
        ("bakery@mill.example", "orders@inn.example", "Bread bill of week 11"),
        ("choir@valley.example", "friends@valley.example", "Songs we practise in spring"),
    ]
    assert [r.message_id for r in rows[:3]] == [
        "<tide-0307@harbour.example>", "<bill-11@mill.example>", "<spring-songs@valley.example>"
    ]
    sent = mails.orderBy("uid").select(F.unix_seconds("sent_ts")).collect()
    assert sent[0][0] == dt.datetime(2024, 3, 7, 6, 15, tzinfo=UTC).timestamp()
    assert sent[3][0] is None
    assert (rows[3].sender, rows[3].subject) == ("Jörg <joerg@example.com>", "Grüße")
    assert (rows[5].sender, rows[5].subject, rows[5].message_id) == ("unknown", "", "")


def test_part_counts(mails):
    counts = dict(explode_parts(mails).groupBy("uid").count().collect())
    assert counts == {2: 2, 3: 2, 4: 5, 5: 3}
    assert parts(mails).count() == 12


def test_attachments(mails):
    rows = attachments(mails).orderBy("uid", "part_path").collect()
    found = [(r.uid, r.part_path, r.filename, r.mime_type, r.size, bytes(r.content)) for r in rows]
    assert found[0] == (2, [1], "invoice.txt", "text/plain", 11, b"Total: 100\n")
    assert found[1] == (4, [0, 1], "béta.pdf", "application/pdf", 12, b"pdf bytes")
    assert found[2][1:4] == ([1], "attachment_1", "message/rfc822")
    assert found[2][5].startswith(b"Subject: inside") and found[2][5].endswith(b"--deep--")
    assert found[3][1:] == ([2], "big.bin", "text/plain", 40, b"0123456789" * 4)
    assert found[4][1:] == ([3], "attachment_3", "text/plain", 8, b"nameless")
    # The unreadable part ends the list of its mail; the part before it stays.
    assert [f[2] for f in found[5:]] == ["good.txt"]
    assert {r.parent_message_id for r in rows if r.uid == 5} == {""}


def test_caps(mails):
    nested = mails.filter("uid = 4")
    names = [r.filename for r in attachments(nested, max_size=39, max_count=3)
             .orderBy("part_path").collect()]
    assert names == ["béta.pdf", "attachment_3"]
    names = [r.filename for r in attachments(nested, max_count=2).orderBy("part_path").collect()]
    assert names == ["béta.pdf", "attachment_1"]
    # A part above the size cap is passed over unread, so its fault does not matter.
    faulty = mails.filter("uid = 5")
    names = [r.filename for r in attachments(faulty, max_size=5).orderBy("part_path").collect()]
    assert names == ["good.txt", "after.txt"]


def test_attachment_predicate(spark):
    rows = spark.createDataFrame(
        [("attachment", None), ("ATTACHMENT", "f"), (None, "f"), (None, None), ("inline", "f")],
        "disposition string, filename string",
    ).select(is_attachment(F.col("disposition"), F.col("filename"))).collect()
    assert [r[0] for r in rows] == [True, True, True, False, False]


def test_parent(mails):
    linked = with_parent(attachments(mails), mails, "subject").collect()
    assert {(r.uid, r.parent_subject) for r in linked} == {(2, "Bread bill of week 11"), (4, "Grüße")}


def test_attributes(mails):
    rows = attachments(mails.filter("uid = 2")).select(attachment_attributes().alias("a"))
    assert rows.first().a == {
        "attachment.filename": "invoice.txt", "attachment.mime.type": "text/plain",
        "attachment.size": "11", "email.folder": "INBOX", "email.subject": "Bread bill of week 11",
        "email.from": "bakery@mill.example", "email.parent.message.id": "<bill-11@mill.example>",
    }


def test_container_without_boundary_gives_no_attachments(mails):
    bad = mails.filter("uid = 6")
    assert attachments(bad).count() == 0
    assert bad.first().parts[0].fault == "Missing start boundary"
    run = fetch(bad, FetchOptions(include_attachments=True), capped=False)
    assert (run.success.count(), run.parse_error.count()) == (1, 0)


def test_content_is_the_body_without_headers(mails):
    rows = {r.uid: bytes(r.content) for r in mails.select("uid", "content").collect()}
    assert rows[1] == b"See you at two.\n"
    assert rows[2].startswith(b"--cut\n") and rows[2].endswith(b"--cut--")


def test_body_faults_matter_only_with_the_body(spark):
    raws = [b"Content-Transfer-Encoding: x-odd\n\nx",
            b"Content-Transfer-Encoding: base64\n\nQUI",
            b"Content-Transfer-Encoding: BASE64\n\nQU I=\n",
            b"\nonly a body", b"Subject: only a head"]
    landed = spark.createDataFrame(
        [("F", n, None, len(r), bytearray(r)) for n, r in enumerate(raws, start=1)], RAW)
    mails = ingest(landed)
    reasons = {r.uid: (r.error_type, r.error_message) for r in errors(mails).collect()}
    assert reasons == {
        1: ("MESSAGE_PROCESSING_ERROR", "Unknown encoding: x-odd"),
        2: ("MESSAGE_PROCESSING_ERROR", "incomplete base64 data"),
    }
    assert errors(mails, full_message=False).count() == 0
    bodies = {r.uid: r.content and bytes(r.content) for r in mails.collect()}
    assert bodies == {1: None, 2: None, 3: b"AB", 4: b"only a body", 5: b""}


def test_unreadable_header_hides_what_follows(spark):
    raw = b"From: a@x\nTo: <broken\nSubject: s\nMessage-ID: <m@x>\n\nbody"
    landed = spark.createDataFrame(
        [("F", 1, dt.datetime(2024, 1, 1), len(raw), bytearray(raw))], RAW)
    mails = ingest(landed)
    row = project_headers(mails).first()
    assert (row.subject, row.sender) == ("s", "a@x")
    assert [row[n] for n in ("to_addr", "cc_addr", "received_ts", "sent_ts", "flags", "size",
                             "message_id", "in_reply_to")] == [None] * 8
    tagged = fetch(mails, FetchOptions(folder="F"), capped=False, batch_id="b").tagged().first()
    assert tagged.attributes == {"email.subject": "s", "email.from": "a@x", "email.batch.id": "b",
                                 "email.folder": "F", "email.uid": "1"}


@pytest.mark.parametrize("text, plain", [
    ("plain", "plain"),
    ("=?utf-8?q?caf=C3=A9_au_lait?=", "café au lait"),
    ("=?ISO-8859-1?B?6Q==?=", "é"),
    ("=?utf-8*fr?q?=C3=A9?=", "é"),
    ("=?utf-8?q?a?= =?utf-8?q?b?=", "ab"),
    ("=?utf-8?q?a?= b =?utf-8?q?c?=", "a b c"),
    ("x=?utf-8?q?a?=", "x=?utf-8?q?a?="),
    ("=?x-none?q?a?= =?utf-8?q?b?=", "=?x-none?q?a?= =?utf-8?q?b?="),
    ("=?utf-8?b?!?=", ""),
    ("=?utf-8?q?a", "=?utf-8?q?a"),
    ("=?us-ascii?q?=FF?=", "�"),
    ("=?utf-7?q?+2AA-?=", "?"),
    ("=?hex?q?ab?=", "=?hex?q?ab?="),
    ("=?idna?q?xn--=FF?=", "=?idna?q?xn--=FF?="),
])
def test_encoded_words(text, plain):
    assert decode_words(text) == plain


def test_addresses():
    assert addresses("a@x, B <b@x>, \"C, D\" <c@x>") == ["a@x", "B <b@x>", '"C, D" <c@x>']
    assert addresses("John Q. Public <j@x>") == ['"John Q. Public" <j@x>']
    assert addresses("undisclosed-recipients:;") == ["undisclosed-recipients:;"]
    assert addresses("  ") == []
    with pytest.raises(MimeFault):
        addresses("<a@x")
    with pytest.raises(MimeFault):
        addresses("only a name <")


def test_transfer_encodings():
    assert decode_body(b"a=3Db=\nc", "quoted-printable") == b"a=bc"
    assert decode_body(b"x", " 8BIT ") == b"x"
    uu = b"begin 644 f\n#0V%T\n`\nend\n"
    assert decode_body(uu, "x-uuencode") == b"Cat"
    with pytest.raises(MimeFault):
        decode_body(b"begin 644 f\n#0V%T\n", "uuencode")


def test_crlf_mail():
    row = parse_mail(INVOICE.replace(b"\n", b"\r\n"))
    assert [p["filename"] for p in row["parts"]] == [None, "invoice.txt"]
    assert row["parts"][1]["content"] == b"Total: 100\r\n"
    assert row["subject"] == "Bread bill of week 11"


def test_folded_and_repeated_headers():
    row = parse_mail(b"To: a@x,\n\tb@x\nTo: c@x\nSubject: one\n two\nReferences:\n <r>\n\n")
    assert row["to_all"] == ["a@x", "b@x", "c@x"]
    assert row["subject"] == "one two"
    assert {"name": "References", "value": "<r>"} in row["headers"]


def test_headers_only_leaves_the_body_alone():
    row = parse_mail(INVOICE, with_content=False)
    assert row["subject"] == "Bread bill of week 11"
    assert row["content"] is None and row["parts"] is None


def test_one_bad_value_does_not_lose_the_batch(monkeypatch):
    from mailloom.sources import ingest as job

    def parse(raw, with_content):
        return {"subject": "\ud800" if raw == b"bad" else raw.decode()}

    monkeypatch.setattr(job, "parse_mail", parse)
    import pyarrow as pa

    landed = pa.RecordBatch.from_pylist([
        {"folder": "F", "uid": n, "msg_num": None, "received_ts": None, "size": 3, "flags": None,
         "raw": raw} for n, raw in enumerate([b"one", b"bad", b"two"])])
    rows = [row for out in job._parse_batches(iter([landed]), True) for row in out.to_pylist()]
    assert [(r["uid"], r["subject"]) for r in rows] == [(0, "one"), (1, None), (2, "two")]
    assert rows[0]["error_message"] is None and "surrogates" in rows[1]["error_message"]


def test_times_do_not_depend_on_the_session_zone(spark, mails):
    expected = mails.orderBy("uid").select(
        F.unix_seconds("sent_ts"), F.unix_seconds("received_ts")).collect()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        raws = [SIMPLE, INVOICE]
        stamp = dt.datetime(2024, 2, 1, tzinfo=UTC)
        landed = spark.createDataFrame(
            [("INBOX", n, stamp, 1, bytearray(raw)) for n, raw in enumerate(raws, start=1)], RAW)
        rows = ingest(landed).orderBy("uid").select(
            F.unix_seconds("sent_ts"), F.unix_seconds("received_ts")).collect()
        assert rows == expected[:2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_odd_mails_are_read(spark):
    deep = b"".join(
        b"Content-Type: multipart/mixed; boundary=b%d\n\n--b%d\n" % (n, n) for n in range(60))
    raws = [b"", b"\r\n", b"\x00\xff\xfe", b"Subject: \xe9\xff\n\n", b"no colon here\n\nx",
            b"Date: Mon, 99 Foo 99999 25:61:61 +9999\n\n", deep + b"\nleaf",
            b"Content-Type: multipart/mixed; boundary=\"\"\n\n--\n\nx\n----\n",
            b"Content-Type: ;;;\nContent-Disposition: \n\nx"]
    landed = spark.createDataFrame(
        [("F", n, None, len(r), bytearray(r)) for n, r in enumerate(raws)], RAW)
    rows = {r.uid: r for r in ingest(landed).collect()}
    assert len(rows) == len(raws)
    assert all(r.error_message is None for r in rows.values())
    assert rows[6].parts[0].part_path == [0] * 60
    assert rows[3].subject == "\ufffd\ufffd"
