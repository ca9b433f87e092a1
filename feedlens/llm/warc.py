"""Operator 3, WARC derivatives: linked metadata and plain-text conversion records.

A response record becomes a ``metadata`` record (warc-fields: title, language,
outlinks, source digest) and a ``conversion`` record (plain text). Both refer
to the response by WARC-Refers-To, keep its target URI, date and other source headers,
and carry digests of their own blocks beside the source's payload
digest. Record ids are name-based: the same response gives the same ids, so a
retried task writes the same records.

Text extraction: comments, scripts and styles go; block elements end a line,
table cells are set apart by a blank, other tags leave nothing; then character
references are resolved once (named ones of HTML 4 and ``apos``, decimal and
hexadecimal numbers), so ``&amp;lt;`` becomes ``&lt;``. Numbers 128 to 159 mean
Windows-1252, zero, surrogates and numbers past U+10FFFF give U+FFFD, a
no-break space is a blank; unknown names and references without a semicolon
stay as they are. Titles and outlinks are resolved alike.

Everything is one pass of built-in functions over the responses, no shuffle.

Defined cases: null html is an empty payload (empty text, no title); a null
url leaves the target URI out of the header; repeated responses give repeated
records; an empty table gives an empty result; other columns of the input
are not looked at.
"""

from __future__ import annotations

from html.entities import name2codepoint
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE = "1970-01-01T00:00:00Z"
PAYLOAD_TYPE = "text/html; charset=utf-8"


def _tags(names: str) -> str:
    """A pattern of the start and end tags of ``names``, in either case; names of one first letter stand together."""
    def letters(name: str) -> str:
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)

    groups = groupby(sorted(names.split()), key=lambda name: name[0])
    either = "|".join(f"{letters(first)}({'|'.join(letters(name[1:]) for name in some)})" for first, some in groups)
    return rf"</?({either})([ \t\r\n/][^>]*)?>"


# Character references by name, the most frequent first, and the numbers that do not mean their own code point.
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}
NAMED |= {name: chr(code) for name, code in name2codepoint.items() if name not in NAMED}
NUMBERED = {n: c for n in range(128, 160) if (c := bytes([n]).decode("cp1252", "ignore"))} | {160: " "}
MOST_DIGITS = 7  # of a number, leading zeros aside; no code point has more

# Markup rules, in order: (pattern, replacement). Classes instead of flags, so
# that every regular-expression library reads them alike.
MARKUP = (
    (r"<!--(?s:.*?)-->", ""),
    (r"<[sS][cC][rR][iI][pP][tT][^>]*>(?s:.*?)</[sS][cC][rR][iI][pP][tT][^>]*>", ""),
    (r"<[sS][tT][yY][lL][eE][^>]*>(?s:.*?)</[sS][tT][yY][lL][eE][^>]*>", ""),
    (_tags("p div br li ul ol dl dt dd tr table caption thead tbody tfoot h1 h2 h3 h4 h5 h6 title article section header footer main aside nav"
           " head body address blockquote pre figure figcaption form fieldset option hr details summary"), "\n"),
    (_tags("td th"), " "),
    (r"<[/!a-zA-Z][^>]*>", ""),
)
# Runs of blanks become one (a single space is left alone), then line ends lose the blanks and empty lines around them.
BLANKS = ((r" [ \t\r\f]+|[\t\r\f][ \t\r\f]*", " "), (r" ?\n[ \n]*", "\n"))
ENDS = " \n"  # taken off both ends of a text
TITLE = r"<[tT][iI][tT][lL][eE][^>]*>([^<]*)</"
LANGUAGE = r"<[hH][tT][mM][lL][^>]* lang=\"([^\"]*)\""
LINK = r"<[aA] [^>]*href=\"([^\"]*)\""


def _replaced(text: Column, rules) -> Column:
    for pattern, put in rules:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(put.replace("\\", "\\\\").replace("$", "\\$")))
    return text


def _map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def resolved(text: Column) -> Column:
    """``text`` with its character references resolved, each once."""
    def number(digits: Column, value: Column) -> Column:
        return F.when(F.length(digits) > MOST_DIGITS, 0).otherwise(value.cast("bigint"))

    named = _map({f"{name};": char for name, char in NAMED.items()})

    def piece(p: Column) -> Column:  # what follows one ampersand
        decimal, hexadecimal = (F.regexp_extract(p, x, 1) for x in ("^#0*([0-9]+);", "^#[xX]0*([0-9a-fA-F]+);"))
        code = F.when(decimal != "", number(decimal, decimal)).when(hexadecimal != "", number(hexadecimal, F.conv(hexadecimal, 16, 10)))
        none = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        by_number = F.when(none, "\ufffd").otherwise(F.coalesce(F.try_element_at(_map(NUMBERED), code.cast("int")), char))
        by_name = F.try_element_at(named, F.substring(p, F.lit(1), F.instr(p, ";")))
        found = F.when(p.startswith("#"), F.when(code.isNotNull(), by_number)).otherwise(by_name)
        return F.coalesce(F.concat(found, F.substring(p, F.instr(p, ";") + 1, F.length(p))), F.concat(F.lit("&"), p))

    # One reference to ``text``: whatever computes it runs once.
    return F.array_join(F.transform(F.split(text, "&", -1), lambda p, i: F.when(i == 0, p).otherwise(piece(p))), "")


def plain_text(html: Column) -> Column:
    return F.btrim(_replaced(resolved(_replaced(html, MARKUP)), BLANKS), F.lit(ENDS))


def _urn(name: Column) -> Column:
    h = F.md5(name)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(text, "UTF-8"), 256))


def responses(pages: DataFrame, *, date: str = DATE) -> DataFrame:
    """Response records of crawled pages (page_id, url, html): one row each."""
    url, html = F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit(""))
    name = F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce(url, F.lit("")), F.md5(html))
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), _urn(name).alias("record_id"), url.alias("target_uri"), F.lit(date).alias("date"),
        F.create_map(F.lit("Content-Type"), F.lit(PAYLOAD_TYPE)).alias("headers"), html.alias("payload"),
    )


def derivatives(source: DataFrame) -> DataFrame:
    """Two records per response: ``page_id, warc_type, record_id, refers_to, target_uri, date, content_type, source_headers,
    source_digest, block_digest, content_length, block``."""
    base = source.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("headers").alias("source_headers"), "payload")
    base = base.withColumn("source_digest", _digest(F.col("payload")))
    title = F.trim(F.regexp_replace(resolved(F.regexp_extract("payload", TITLE, 1)), "[ \t\r\n\f]+", " "))
    links = F.transform(F.regexp_extract_all("payload", F.lit(LINK), F.lit(1)), lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(resolved(x), "[\r\n]", ""), F.lit("\r\n")))
    fields = F.concat(
        F.lit("title: "), title, F.lit("\r\nlanguage: "), F.regexp_replace(F.regexp_extract("payload", LANGUAGE, 1), "[\r\n]", ""),
        F.lit("\r\nsource-digest: "), F.col("source_digest"), F.lit("\r\n"), F.array_join(links, ""),
    )

    def record(kind: str, content_type: str, block: Column) -> Column:
        return F.struct(F.lit(kind).alias("warc_type"), F.lit(content_type).alias("content_type"), block.alias("block"))

    both = base.select("page_id", "refers_to", "target_uri", "date", "source_headers", "source_digest", F.inline(F.array(
        record("metadata", "application/warc-fields", fields), record("conversion", "text/plain; charset=utf-8", plain_text(F.col("payload"))),
    )))
    return both.select(
        "page_id", "warc_type", _urn(F.concat_ws("|", "warc_type", "refers_to")).alias("record_id"), "refers_to", "target_uri", "date", "content_type",
        "source_headers", "source_digest", _digest(F.col("block")).alias("block_digest"), F.octet_length("block").cast("bigint").alias("content_length"), "block",
    )


def as_text(records: DataFrame) -> DataFrame:
    """``record``: each record as WARC/1.1 text, header, block and the two closing line ends.

    ``df.write.option("lineSep", "\\n")`` style text sinks keep one record a row;
    source headers are kept as ``WARC-Source-<name>`` lines.
    """
    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")

    kept = F.array_join(F.transform(F.map_entries("source_headers"), lambda e: F.concat(F.lit("WARC-Source-"), e["key"], F.lit(": "), e["value"], F.lit("\r\n"))), "")
    return records.select(F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")), line("WARC-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("date")),
        line("WARC-Block-Digest", F.col("block_digest")), line("WARC-Payload-Digest", F.col("source_digest")), kept,
        line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length").cast("string")), F.lit("\r\n"), F.col("block"),
        F.lit("\r\n\r\n"),
    ).alias("record"))
