"""What a task does to one document at a time: the steps of ``decode``, ``gate`` and ``markup_tree`` on plain values.

The column expressions are the way for whole columns; these are for stages that must time, limit or retry each document alone.
Errors carry the type and message that the expressions give, and no message quotes content.
"""

from __future__ import annotations

import base64
import errno
import re
import signal
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from . import markup_tree
from .decode import BASE64_ERROR, CP1252, DECODER_ERROR, EMPTY_FILE, EMPTY_PAYLOAD, MARKS, META_CHARSET, NATIVE, NOT_BASE64, NOT_UTF8, PROBE_BYTES, UTF8, XML_ENCODING, known_charset
from .gate import CONTROL_SHARE, ELEMENT, NOT_XHTML, PROBE_CHARS
from .markup_tree import WHITE, CleanUp

XML, META, IS_ELEMENT = re.compile(XML_ENCODING), re.compile(META_CHARSET, re.A), re.compile(ELEMENT)
SCRIPT = re.compile("(?i)<script\\b[^>]*>[\\s\\S]*?</script\\s*>")
CONTROL = re.compile("[\\x00-\\x08\\x0b\\x0e-\\x1f\\x7f-\\x9f]")
FAILED = "The document could not be converted."
OVERTIME = "The conversion took longer than it may."
GONE = "The file is gone."
EXISTS = "The output already exists and overwriting is off."
DISK_FULL = 0x70


class DocumentError(Exception):
    """A fault of a document, with the type that reports show."""

    def __init__(self, kind: str, message: str, hresult: int = 0):
        super().__init__(message)
        self.kind, self.message, self.hresult = kind, message, hresult


class Overtime(BaseException):
    """Raised by the clock of ``limited``; no handler for usual errors stops it."""


def described(e: BaseException) -> DocumentError:
    """Any error as a ``DocumentError``; messages of others are not passed on, since they may quote content."""
    if isinstance(e, DocumentError):
        return e
    if isinstance(e, (Overtime, TimeoutError)):
        return DocumentError("TimeoutException", OVERTIME)
    if isinstance(e, FileNotFoundError):
        return DocumentError("FileNotFoundException", GONE)
    if isinstance(e, PermissionError):
        return DocumentError("UnauthorizedAccessException", FAILED)
    if isinstance(e, MemoryError):
        return DocumentError("OutOfMemoryException", FAILED)
    if isinstance(e, OSError):
        full = e.errno in (errno.ENOSPC, errno.EDQUOT)
        return DocumentError("PathTooLongException" if e.errno == errno.ENAMETOOLONG else "IOException", FAILED, DISK_FULL if full else 0)
    return DocumentError(type(e).__name__, FAILED)


@contextmanager
def limited(seconds: float) -> Iterator[None]:
    """Stops what runs inside after so many seconds, 0 for never. The clock interrupts Python code and patterns, not a call into other native code."""
    if not seconds or threading.current_thread() is not threading.main_thread():
        yield
        return

    def over(*_):
        raise Overtime

    before = signal.signal(signal.SIGALRM, over)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def _mark(data: bytes) -> tuple[str | None, bytes]:
    """Name of a leading byte order mark, and the bytes after it."""
    for mark, name in MARKS:
        if data.startswith(bytes.fromhex(mark)):
            return name, data[len(mark) // 2 :]
    return None, data


def payload_of(content: bytes | None) -> bytes:
    """The payload of a Base64 envelope."""
    if not content:
        raise DocumentError(BASE64_ERROR, EMPTY_FILE)
    name, body = _mark(content)
    if name and name != "UTF-8":
        body = body.replace(b"\0", b"")
    body = body.translate(None, b" \t\r\n")
    try:
        if len(body) % 4:
            raise ValueError
        payload = base64.b64decode(body, validate=True)
    except ValueError as e:
        raise DocumentError(BASE64_ERROR, NOT_BASE64) from e
    if not payload:
        raise DocumentError(BASE64_ERROR, EMPTY_PAYLOAD)
    return payload


def text_of(payload: bytes) -> str:
    """Text by the byte order mark, else the declared charset, else strict UTF-8, else windows-1252."""
    name, body = _mark(payload)
    if name:
        return body.decode(name, "replace")
    head = payload[:PROBE_BYTES].decode("latin-1")
    xml, meta = XML.search(head), META.search(head)
    declared = (xml or meta)[1].strip(" ").lower() if xml or meta else None
    if declared in UTF8:
        try:
            return payload.decode("utf-8")
        except UnicodeDecodeError as e:
            raise DocumentError(DECODER_ERROR, NOT_UTF8) from e
    codec = known_charset(NATIVE.get(declared, declared))
    if codec == "cp1252":
        return payload.decode("latin-1").translate(dict(enumerate(CP1252)))
    if codec:
        try:
            return payload.decode(codec, "replace")
        except (LookupError, UnicodeError, TypeError, ValueError):
            pass
    try:
        return payload.decode("utf-8")
    except UnicodeDecodeError:
        return payload.decode("latin-1").translate(dict(enumerate(CP1252)))


def validate(text: str) -> None:
    """Raises where a text holds no document."""
    if not text.strip(WHITE):
        raise DocumentError(NOT_XHTML, "The payload is empty; there is no document to convert.")
    head = text[:PROBE_CHARS]
    if len(CONTROL.findall(head)) > CONTROL_SHARE * len(head):
        raise DocumentError(NOT_XHTML, "The payload is binary content, not markup.")
    if not IS_ELEMENT.search(text):
        raise DocumentError(NOT_XHTML, "The payload holds no element; it is not a document.")


def clean(text: str, o: CleanUp) -> str:
    """The clean-up passes in their order."""
    if o.scripts:
        text = SCRIPT.sub("", text)
    if not o.styled:
        text = markup_tree.remove_root_namespaces(text) if o.namespaces else text
        text = markup_tree.remove_empty_anchors(text) if o.anchors else text
    return markup_tree.clean_tree(text, o)


def base64_line(data: bytes) -> bytes:
    return base64.b64encode(data)
