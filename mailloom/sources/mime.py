"""Reading one raw mail: headers, body bytes and the leaves of its MIME tree.

This is the only work in the package that runs in Python per row. It is called
for each row of an Arrow batch inside a task.
"""

from __future__ import annotations

import binascii
import codecs
import datetime as dt
import quopri
import re
from collections.abc import Iterator
from email import message, quoprimime, utils

_HEAD_END = re.compile(rb"\A\r?\n|\r?\n\r?\n")
_FIELD = re.compile(r"^([^\s:]+)[ \t]*:[ \t]*(.*(?:\n[ \t].*)*)", re.MULTILINE)
_FOLD = re.compile(r"\r?\n(?=[ \t])")
_BARE_ADDRESS = re.compile(r"\A[^\s<>@,\"():;\\\[\]]+@[^\s<>@,\"():;\\\[\]]+\Z")
_FIRST_MARKER = re.compile(rb"^--(\S.*?)[ \t]*\r?$", re.MULTILINE)
_GROUP = re.compile(r"\A[^<>@\",:]+:[^;]*;\Z")
_ENCODED_WORD = re.compile(r"(?<![^\s\0])=\?([^?\s]+)\?([bBqQ])\?([^?\s]*)\?=")
_BETWEEN_WORDS = re.compile(r"(=\?[^?\s]+\?[bBqQ]\?[^?\s]*\?=)\s+(?==\?[^?\s]+\?[bBqQ]\?)")
_SPECIALS = re.compile(r'[][\\()<>@,;:".]')


class MimeFault(ValueError):
    """A part of a mail that cannot be read."""


class Head:
    """The header block of a mail or of a part."""

    def __init__(self, text: str) -> None:
        self.fields = [
            (name, _FOLD.sub("", value).strip()) for name, value in _FIELD.findall(text)
        ]
        self._by_name: dict[str, list[str]] = {}
        for name, value in self.fields:
            self._by_name.setdefault(name.lower(), []).append(value)

    def all(self, name: str) -> list[str]:
        return self._by_name.get(name, [])

    def first(self, name: str) -> str | None:
        return next(iter(self.all(name)), None)

    @property
    def main_type(self) -> str:
        return (self.first("content-type") or "text").split("/")[0].strip().lower()

    def with_parameters(self) -> message.Message:
        """Content headers as a standard message, which reads their parameters."""
        holder = message.Message()
        for name in ("content-type", "content-disposition"):
            value = self.first(name)
            if value is not None:
                holder[name] = value
        return holder


def split_head(raw: bytes) -> tuple[Head, bytes]:
    """Header block and body bytes of a mail or of a part."""
    end = _HEAD_END.search(raw)
    head, body = (raw[: end.start()], raw[end.end():]) if end else (raw, b"")
    return Head(head.decode("utf-8", "replace")), body


def whole_text(text: str) -> str:
    """The text without half characters, which some charsets can produce."""
    return text.encode("utf-8", "replace").decode("utf-8")


def decode_words(text: str) -> str:
    """RFC 2047 encoded words as plain text; unchanged when a charset is unknown."""
    if "=?" not in text:
        return text

    def plain(word: re.Match) -> str:
        charset, encoding, data = word[1].split("*")[0], word[2], word[3]
        if "\0" in charset:
            raise LookupError(charset)
        codecs.lookup(charset)
        try:
            if encoding in "bB":
                octets = binascii.a2b_base64(data)
            else:
                octets = quoprimime.header_decode(data).encode("latin-1")
            return whole_text(octets.decode(charset, "replace"))
        except ValueError:
            return word[0]

    try:
        return _ENCODED_WORD.sub(plain, _BETWEEN_WORDS.sub(r"\1\0", text)).replace("\0", "")
    except LookupError:
        return text


def addresses(value: str) -> list[str]:
    """Addresses of a header value as ``name <address>`` or bare address."""
    value = value.strip()
    if not value:
        return []
    if _BARE_ADDRESS.match(value):
        return [value]
    if _GROUP.match(value):
        return [decode_words(value)]
    unquoted = re.sub(r'"(?:[^"\\]|\\.)*"', "", value)
    if unquoted.count("<") != unquoted.count(">"):
        raise MimeFault("unbalanced < in address list")
    found = []
    for name, address in utils.getaddresses([value], strict=False):
        if not address:
            raise MimeFault("no address after a name")
        if name:
            if _SPECIALS.search(name):
                name = '"' + re.sub(r'([\\"])', r"\\\1", name) + '"'
            address = f"{name} <{address}>"
        found.append(decode_words(address))
    return found


def decode_body(data: bytes, encoding: str | None) -> bytes:
    """Body bytes with the transfer encoding undone."""
    name = (encoding or "").split(";")[0].strip().lower()
    if name in ("", "7bit", "8bit", "binary"):
        return data
    if name == "quoted-printable":
        return quopri.decodestring(data)
    try:
        if name == "base64":
            return binascii.a2b_base64(data)
        if name in ("uuencode", "x-uuencode", "x-uue"):
            lines = iter(data.splitlines())
            for line in lines:
                if line.startswith(b"begin "):
                    break
            octets = b""
            for line in lines:
                if line.strip() == b"end":
                    return octets
                octets += binascii.a2b_uu(line)
            raise MimeFault("missing end of uuencoded body")
    except binascii.Error as fault:
        raise MimeFault(f"incomplete {name} data") from fault
    raise MimeFault(f"Unknown encoding: {encoding}")


def _split_multipart(boundary: str | None, body: bytes) -> list[bytes]:
    if boundary is None:
        guess = _FIRST_MARKER.search(body)
        marker = b"--" + guess[1] if guess else None
    else:
        marker = b"--" + boundary.encode("utf-8")
    pieces: list[bytes] = []
    start: int | None = None
    at = -1 if marker is None else body.find(marker)
    while at >= 0:
        line_end = body.find(b"\n", at)
        line_end = len(body) if line_end < 0 else line_end
        tail = body[at + len(marker):line_end].strip(b" \t\r")
        if (at > 0 and body[at - 1] != 10) or tail not in (b"", b"--"):
            at = body.find(marker, at + 1)
            continue
        if start is not None:
            # The line break before a boundary belongs to the boundary.
            piece = body[start:max(start, at - 1)]
            pieces.append(piece.removesuffix(b"\r"))
        if tail == b"--":
            start = None
            break
        start = min(line_end + 1, len(body))
        at = body.find(marker, start)
    if start is not None:
        pieces.append(body[start:])
    if not pieces:
        raise MimeFault("Missing start boundary")
    return pieces


def _closed_container(path: tuple[int, ...], fault: str) -> dict:
    return {
        "part_path": list(path), "part_index": path[-1] if path else None,
        "disposition": None, "filename": None, "content_type": None, "size": None,
        "container": True, "fault": fault, "content": None,
    }


def _opened(head: Head, body: bytes, path: tuple[int, ...]):
    """The parts of a container, last one first, each with its path."""
    pieces = _split_multipart(head.with_parameters().get_boundary(), body)
    return [((*path, k), *split_head(pieces[k])) for k in range(len(pieces) - 1, -1, -1)]


def _leaves(head: Head, body: bytes) -> Iterator[dict]:
    """The leaves of a mail in order. Containers are kept on a stack, however deep."""
    waiting = [((), head, body)]
    while waiting:
        here, part, data = waiting.pop()
        if not here or part.main_type == "multipart":
            try:
                waiting += _opened(part, data, here)
            except MimeFault as fault:
                yield _closed_container(here, str(fault))
            continue
        index = here[-1]
        kind = part.first("content-type") or "text/plain"
        try:
            described = part.with_parameters()
            disposition = described.get_content_disposition()
            filename = described.get_filename()
            filename = None if filename is None else decode_words(whole_text(filename))
        except Exception:  # parameters that cannot be read
            disposition, kind = "attachment", "application/octet-stream"
            filename = f"attachment_{index}_unknown"
        content, fault = None, None
        if disposition == "attachment" or (disposition is None and filename is not None):
            try:
                if part.main_type == "message":
                    content = data
                else:
                    content = decode_body(data, part.first("content-transfer-encoding"))
            except MimeFault as broken:
                fault = str(broken)
        yield {
            "part_path": list(here),
            "part_index": index,
            "disposition": disposition,
            "filename": filename,
            "content_type": kind,
            "size": len(data),
            "container": False,
            "fault": fault,
            "content": content,
        }


def _sent(value: str | None) -> dt.datetime | None:
    try:
        when = utils.parsedate_to_datetime(value)
        when = when.replace(tzinfo=dt.timezone.utc) if when.tzinfo is None else when
        return when.astimezone(dt.timezone.utc)
    except (TypeError, ValueError, OverflowError):
        return None


#: Address headers: column, header, and the name under which a fault is recorded.
_ADDRESS_COLUMNS = [
    ("from_all", "from", "from"),
    ("sender_all", "sender", None),
    ("to_all", "to", "to"),
    ("cc_all", "cc", "cc"),
    ("bcc_all", "bcc", None),
]


def parse_mail(raw: bytes, with_content: bool = True) -> dict:
    """Columns of one mail; faults are recorded beside what could be read.

    ``with_content=False`` reads the headers only.
    """
    head, body = split_head(raw)
    subject = head.first("subject")
    row: dict = {
        "message_id": head.first("message-id"),
        "in_reply_to": head.first("in-reply-to"),
        "subject": None if subject is None else decode_words(subject),
        "sent_ts": _sent(head.first("date")),
        "headers": [
            {"name": name, "value": decode_words(value)} for name, value in head.fields
        ],
        "header_fault": None,
        "content": None,
        "body_fault": None,
        "parts": None,
    }
    for column, name, place in _ADDRESS_COLUMNS:
        try:
            row[column] = addresses(", ".join(head.all(name)))
        except MimeFault:
            row[column] = []
            if place is not None and row["header_fault"] is None:
                row["header_fault"] = place
    if not with_content:
        return row

    if head.main_type in ("multipart", "message"):
        row["content"] = body
    else:
        try:
            row["content"] = decode_body(body, head.first("content-transfer-encoding"))
        except MimeFault as fault:
            row["body_fault"] = str(fault)
    if head.main_type == "multipart":
        row["parts"] = []
        try:
            row["parts"].extend(_leaves(head, body))
        except Exception as fault:  # trouble with attachments must not fail the mail
            row["parts"].append(_closed_container((), str(fault) or type(fault).__name__))
    return row
