"""Base64 envelopes and character sets, as column expressions.

Errors are structs of type and message, and no message quotes content.
"""

from __future__ import annotations

import codecs

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE64_ERROR = "Base64DecodingException"
DECODER_ERROR = "DecoderFallbackException"
EMPTY_FILE = "The file is empty: there is no Base64 content to decode."
NOT_BASE64 = "The file is not valid Base64 content."
EMPTY_PAYLOAD = "The Base64 content decoded to an empty document."
NOT_UTF8 = "The document declares UTF-8 but holds bytes that are not UTF-8."

#: Byte order marks, in the order in which they are looked for.
MARKS = [("FFFE0000", "UTF-32LE"), ("0000FEFF", "UTF-32BE"), ("EFBBBF", "UTF-8"), ("FFFE", "UTF-16LE"), ("FEFF", "UTF-16BE")]
PROBE_BYTES = 4096
XML_ENCODING = "(?i)<\\?xml[^>]*?encoding\\s*=\\s*[\"']([^\"']+)[\"']"
META_CHARSET = "(?i)<meta[^>]*?charset\\s*=\\s*[\"']?\\s*([\\w-]+)"

NO_ERROR = "cast(null as struct<type: string, message: string>)"


def error_of(kind: str, message: Column | str) -> Column:
    return F.struct(F.lit(kind).alias("type"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` whose results later steps see as plain columns. Expressions that refer to a result several
    times, and filters on what follows from it, would otherwise be expanded again and again while planning."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def byte_mark(content: Column) -> Column:
    """Name of the character set of a leading byte order mark, or null."""
    head, out = F.hex(F.substring(content, 1, 4)), None
    for mark, name in MARKS:
        fits = head.startswith(mark)
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out


def mark_length(name: Column) -> Column:
    out = None
    for mark, n in MARKS:
        out = F.when(name == n, len(mark) // 2) if out is None else out.when(name == n, len(mark) // 2)
    return F.coalesce(out, F.lit(0))


def after_mark(content: Column, name: Column) -> Column:
    return F.substring(content, mark_length(name) + 1, F.greatest(F.octet_length(content), F.lit(1)))


def decode_envelope(df: DataFrame, content: str = "content") -> DataFrame:
    """Adds payload and error of the Base64 envelope in ``content``. Space, tab and line ends are ignored; padding
    is strict. The steps are columns of their own, so that each is computed once."""
    df = staged(df, _mark=byte_mark(F.col(content)))
    df = staged(df, _body=after_mark(F.col(content), F.col("_mark")))
    # Base64 is ASCII: in a wide mark's text the other bytes of a valid envelope are zero
    text = F.decode("_body", "ISO-8859-1")
    wide = F.col("_mark").isin("UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-32BE")
    text = F.when(wide, F.replace(text, F.lit("\x00"), F.lit(""))).otherwise(text)
    df = staged(df, _text=F.regexp_replace(text, "[ \\t\\r\\n]", ""))
    valid = (F.length("_text") % 4 == 0) & F.col("_text").rlike("^[A-Za-z0-9+/]*={0,2}$")
    df = staged(df, _valid=valid)
    df = staged(df, payload=F.when(F.col("_valid"), F.try_to_binary("_text", F.lit("base64"))))
    error = (
        F.when(F.coalesce(F.octet_length(content), F.lit(0)) == 0, error_of(BASE64_ERROR, EMPTY_FILE))
        .when(~F.col("_valid") | F.col("payload").isNull(), error_of(BASE64_ERROR, NOT_BASE64))
        .when(F.octet_length("payload") == 0, error_of(BASE64_ERROR, EMPTY_PAYLOAD))
        .otherwise(F.expr(NO_ERROR))
    )
    df = staged(df, error=error, payload=F.when(F.octet_length("payload") > 0, F.col("payload")))
    return df.drop("_mark", "_body", "_text", "_valid")


def declared_charset(payload: Column) -> Column:
    """Lower-cased name in an XML declaration, else in a meta tag; null without either. A declaration
    that is there keeps the meta tag from being read."""
    head = F.decode(F.substring(payload, 1, PROBE_BYTES), "ISO-8859-1")
    xml = F.regexp_extract(head, XML_ENCODING, 1)
    meta = F.regexp_extract(head, META_CHARSET, 1)
    return F.lower(F.trim(F.when(xml != "", xml).when(meta != "", meta)))


#: The five bytes of windows-1252 that Python's codec refuses stand for C1 controls.
CP1252 = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(256))


def known_charset(name: str | None) -> str | None:
    """The codec's name of a charset, or None where it isn't known."""
    try:
        return codecs.lookup(name).name if name else None
    except (LookupError, ValueError):
        return None


@F.udf(T.StringType(), useArrow=False)  # a hundred rows at a time, see rtf.render
def decode_rare(data: bytearray | None, name: str | None) -> str | None:
    """Text in a code page that the JVM expression doesn't offer; null where the name is unknown."""
    codec = known_charset(name)
    if data is None or codec is None:
        return None
    if codec == "cp1252":
        return bytes(data).decode("latin-1").translate(dict(enumerate(CP1252)))
    try:
        return bytes(data).decode(codec, "replace")
    except (LookupError, UnicodeError, TypeError, ValueError):
        return None


#: Charset names that are decoded without leaving the JVM.
NATIVE = {"us-ascii": "US-ASCII", "ascii": "US-ASCII", "iso-8859-1": "ISO-8859-1", "latin1": "ISO-8859-1", "utf-16": "UTF-16", "utf-16le": "UTF-16LE", "utf-16be": "UTF-16BE"}
UTF8 = ("utf-8", "utf8")


def decode_text(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds text, encoding and text_error of the bytes in ``payload``: byte order mark, then declared
    charset, then strict UTF-8, then windows-1252. Bytes that are not UTF-8 are replaced after a mark, and
    an error after a declaration."""
    df = staged(df, _mark=byte_mark(F.col(payload)), _valid8=F.is_valid_utf8(F.col(payload).cast("string")))
    declared = F.when(F.col("_mark").isNull(), declared_charset(F.col(payload)))
    df = staged(df, _declared=declared, _body=after_mark(F.col(payload), F.col("_mark")))
    is8 = F.coalesce(F.col("_declared").isin(*UTF8), F.lit(False))
    native = F.coalesce(F.col("_declared").isin(*NATIVE), F.lit(False))
    # charset of the bytes that the UDF decodes: wide marks, rare names, and windows-1252 for what is no UTF-8
    free = ~is8 & ~F.col("_valid8") & F.col("_mark").isNull() & ~native
    rare = F.when(F.col("_mark").startswith("UTF-32"), F.lower("_mark")).when(F.col("_declared").isNotNull() & ~is8 & ~native, F.col("_declared"))
    df = df.withColumn("_rare", F.when(rare.isNotNull(), decode_rare(F.when(rare.isNotNull(), F.col("_body")), rare)))
    df = df.withColumn("_1252", F.when(free & F.col("_rare").isNull(), decode_rare(F.when(free & F.col("_rare").isNull(), F.col(payload)), F.lit("windows-1252"))))
    declared = None
    for name, jvm in NATIVE.items():
        got = F.decode(F.col(payload), jvm)
        declared = F.when(F.col("_declared") == name, got) if declared is None else declared.when(F.col("_declared") == name, got)
    text = F.when(F.col("_mark") == "UTF-8", F.make_valid_utf8(F.col("_body").cast("string")))
    text = text.when(F.col("_mark") == "UTF-16LE", F.decode("_body", "UTF-16LE")).when(F.col("_mark") == "UTF-16BE", F.decode("_body", "UTF-16BE"))
    text = text.when(is8, F.when(F.col("_valid8"), F.col(payload).cast("string"))).when(native, declared).when(F.col("_rare").isNotNull(), F.col("_rare"))
    text = text.otherwise(F.when(F.col("_valid8"), F.col(payload).cast("string")).otherwise(F.col("_1252")))
    used = F.when(F.col("_mark").isNotNull(), F.col("_mark")).when(is8, "UTF-8").when(native | F.col("_rare").isNotNull(), F.col("_declared"))
    used = used.otherwise(F.when(F.col("_valid8"), "UTF-8").otherwise("windows-1252"))
    bad = F.col("_mark").isNull() & is8 & ~F.col("_valid8")
    error = F.when(bad, error_of(DECODER_ERROR, NOT_UTF8)).otherwise(F.expr(NO_ERROR))
    return staged(df, text=text, encoding=used, text_error=error).drop("_mark", "_declared", "_valid8", "_body", "_rare", "_1252")


def read_documents(df: DataFrame, content: str = "content") -> DataFrame:
    """Adds text, encoding, input_bytes (of the envelope) and error of each envelope in ``content``."""
    out = decode_envelope(df, content).withColumn("input_bytes", F.coalesce(F.octet_length(content), F.lit(0)).cast("long"))
    out = decode_text(out)
    out = staged(out, error=F.coalesce("error", "text_error"))
    good = F.col("error").isNull()
    return staged(out, text=F.when(good, F.col("text")), encoding=F.when(good, F.col("encoding"))).drop("payload", "text_error")


def base64_line(data: Column) -> Column:
    """A one-line Base64 envelope."""
    return F.regexp_replace(F.base64(data), "[\\r\\n]", "")
