"""Scalar functions as column expressions; only the three that no expression can state are Arrow-batched Python."""

from __future__ import annotations

import codecs
import json
import zlib
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlake.functions import tables

HUB, HUB_API = "https://github.com/", "https://api.github.com/repos/"


def lookup(key: Column, table: dict[str, str], default: str | None = None) -> Column:
    """A small constant table as one map literal."""
    entries = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(entries, key), F.lit(default).cast("string"))


# --- urls -----------------------------------------------------------------------------------------------------------------


def url_kind(url: Column) -> Column:
    """``GitHub``, ``Git`` or null, with case: hub urls, hub api urls, other https urls ending in ``.git``."""
    return F.when(url.startswith(HUB) | url.startswith(HUB_API), "GitHub").when(url.startswith("https://") & url.endswith(".git"), "Git")


def url_name(url: Column) -> Column:
    """What identifies the project within its kind; the ending ``.git`` stays on hub api urls."""
    hub = F.regexp_replace(F.substring(url, len(HUB) + 1, 10_000), r"\.git$", "")
    other = F.regexp_replace(F.substring(url, len("https://") + 1, 10_000), r"\.git$", "")
    return F.when(url.startswith(HUB), hub).when(url.startswith(HUB_API), F.substring(url, len(HUB_API) + 1, 10_000)).when(url_kind(url) == "Git", other)


def clone_url(kind: Column, name: Column) -> Column:
    return F.concat(F.when(kind == "GitHub", F.lit(HUB)).otherwise(F.lit("https://")), name, F.lit(".git"))


def matches_url(kind: Column, name: Column, url: Column) -> Column:
    """The url, with or without its scheme, host and ending, is the one of the project; a bare name matches too."""
    bare = F.regexp_replace(url, r"\.git$", "")
    hub = F.regexp_replace(bare, r"^(?:https?://github\.com/|https://api\.github\.com/repos/)", "")
    return F.when(kind == "GitHub", hub == name).otherwise(F.regexp_replace(bare, "^https?://", "") == name)


def commit_link(kind: Column, name: Column, sha: Column) -> Column:
    """A terminal hyperlink to a commit of a hub project, else the plain hash."""
    return F.when(kind == "GitHub", _link(F.concat(F.lit(HUB), name, F.lit("/commit/"), sha), sha)).otherwise(sha)


def change_link(kind: Column, name: Column, sha: Column, path: Column, hash_id: Column) -> Column:
    """A terminal hyperlink to a file at a commit; the plain path if the file was deleted."""
    return F.when((kind == "GitHub") & (hash_id != 0), _link(F.concat(F.lit(HUB), name, F.lit("/blob/"), sha, F.lit("/"), path), path)).otherwise(path)


def _link(target: Column, shown: Column) -> Column:
    return F.concat(F.lit("\x1b]8;;"), target, F.lit("\x07"), shown, F.lit("\x1b]8;;\x07"))


# --- kinds and languages --------------------------------------------------------------------------------------------------


def contents_kind(path: Column) -> Column:
    """Kind by what follows the last dot of the whole path (all of it without a dot), with case; else null."""
    return lookup(F.element_at(F.split(path, r"\."), -1), tables.KIND_OF_ENDING)


def stored_kind(contents: Column, kind: Column) -> Column:
    return F.when(F.length(contents) < tables.SMALL_FILE, "SmallFiles").otherwise(kind)


def file_language(path: Column) -> Column:
    """Language by the extension of the file name; a leading dot starts none; unknown ones give an empty text."""
    return lookup(F.regexp_extract(path, r"[^/]\.([^./]*)$", 1), tables.LANGUAGE_OF_EXTENSION, "")


def store_kind(name: Column) -> Column:
    return lookup(F.lower(name), tables.STORE_ALIASES)


def store_display(kind: Column) -> Column:
    return lookup(kind, {k: v[0] for k, v in tables.STORE_KINDS.items()}, "Unspecified")


def store_number(kind: Column) -> Column:
    return lookup(kind, {k: str(v) for k, v in tables.STORE_NUMBERS.items()}).cast("bigint")


def contents_number(kind: Column) -> Column:
    return lookup(kind, {k: str(v) for k, v in tables.CONTENTS_NUMBERS.items()}).cast("bigint")


def is_bug_fix(message: Column, lowercase: bool = False) -> Column:
    """The message names a fault; with case unless ``lowercase``. A null message names none."""
    text = F.lower(message) if lowercase else message
    return F.coalesce(reduce(lambda a, b: a | b, [text.contains(w) for w in tables.BUG_WORDS]), F.lit(False))


# --- time, numbers, texts -------------------------------------------------------------------------------------------------


def pretty_timestamp(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")


def parse_time(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch seconds, or null if the text is no such time."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit(pattern)))


def rfc1123(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def pretty_duration(seconds: Column) -> Column:
    """``1d 2h 3m 4s`` without the leading units that are zero."""
    s = seconds.cast("bigint")
    part = lambda unit, of: F.format_string("%d", (F.floor(s / F.lit(unit)) % of if of else F.floor(s / F.lit(unit))).cast("bigint"))
    d, h, m, r = F.concat(part(86400, 0), F.lit("d ")), F.concat(part(3600, 24), F.lit("h ")), F.concat(part(60, 60), F.lit("m ")), F.concat(part(1, 60), F.lit("s"))
    return F.when(s >= 86400, F.concat(d, h, m, r)).when(s >= 3600, F.concat(h, m, r)).when(s >= 60, F.concat(m, r)).otherwise(r)


def _scaled(value: Column, units: list[str]) -> Column:
    v = value.cast("bigint")
    text = lambda by, unit: F.concat(F.floor(v / F.lit(by)).cast("bigint").cast("string"), F.lit(unit))
    return F.when(v < 10**3, v.cast("string")).when(v < 10**6, text(10**3, units[0])).when(v < 10**9, text(10**6, units[1])).otherwise(text(10**9, units[2]))


def pretty_value(value: Column) -> Column:
    return _scaled(value, ["k", "m", "b"])


def pretty_size(value: Column) -> Column:
    return _scaled(value, ["kb", "mb", "gb"])


def percent(value: Column, most: Column) -> Column:
    """Whole percent, ``??`` of nothing."""
    return F.when(most == 0, "??").otherwise(F.floor(value * 100 / F.nullif(most, F.lit(0))).cast("bigint").cast("string"))


def percent_bar(value: Column, most: Column, width: int = 20) -> Column:
    """A bar of ``width`` characters, filled by the share; empty of nothing."""
    filled = F.coalesce(F.least(F.floor(value * width / F.nullif(most, F.lit(0))), F.lit(width)), F.lit(0)).cast("int")
    return F.concat(F.repeat(F.lit("="), filled), F.repeat(F.lit(" "), F.lit(width) - filled))


def escape_quotes(text: Column) -> Column:
    """In double quotes, with a backslash before quotes of either kind and backslashes."""
    return F.concat(F.lit('"'), F.regexp_replace(text, r"(['\"\\])", r"\\$1"), F.lit('"'))


def split_limit(text: Column, separator: str, limit: int) -> Column:
    """At most ``limit`` parts; the last keeps the rest."""
    return F.split(text, "[" + ("\\" if separator in "^]\\" else "") + separator + "]", limit)


def hex_digit(char: Column) -> Column:
    """Value of a hexadecimal digit, or null."""
    at = F.instr(F.lit("0123456789abcdef"), F.lower(char)) - 1
    return F.when((F.length(char) == 1) & (at >= 0), at)


def sha1_of(value: Column) -> Column:
    return F.sha1(value)


def try_int(text: Column) -> Column:
    return F.expr("try_cast(x as bigint)") if isinstance(text, str) else text.try_cast("bigint")


# --- bytes and json -------------------------------------------------------------------------------------------------------


def _escape(raw: bytes | None) -> str | None:
    def in_percent(e: UnicodeDecodeError) -> tuple[str, int]:
        return f"%{e.object[e.start]:x}", e.start + 1

    codecs.register_error("commitlake.percent", in_percent)
    return None if raw is None else bytes(raw).replace(b"%", b"%%").decode("utf-8", "commitlake.percent")


def escaped_text(raw: Column) -> Column:
    """Any bytes as text without loss: ``%`` doubled, bytes that are no UTF-8 as ``%`` and hexadecimal digits."""
    slow = F.pandas_udf(lambda s: s.map(_escape), T.StringType())
    text = F.try_to_binary(F.lit(""), F.lit("utf-8"))  # keeps the expression typed
    valid = F.is_valid_utf8(raw.cast("string"))
    return F.when(raw.isNull(), F.lit(None)).when(valid, F.replace(raw.cast("string"), F.lit("%"), F.lit("%%"))).otherwise(slow(F.when(~valid, raw).otherwise(text)))


def gzip(raw: Column) -> Column:
    """Gzip of best level, the same bytes for the same input."""

    def pack(s: pd.Series) -> pd.Series:
        def one(b):
            if b is None:
                return None
            c = zlib.compressobj(9, zlib.DEFLATED, 31)
            return c.compress(bytes(b)) + c.flush()

        return s.map(one)

    return F.pandas_udf(pack, T.BinaryType())(raw)


def gunzip(raw: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(lambda b: None if b is None else zlib.decompress(bytes(b), 47)), T.BinaryType())(raw)


def json_value(document: Column, path: str, kind: str) -> Column:
    """A field of a JSON text if it has that type (``string``, ``bigint``, ``boolean``, ``double``), else null; broken JSON gives null."""
    names = {"string": ("STRING",), "bigint": ("BIGINT",), "boolean": ("BOOLEAN",), "double": ("DOUBLE", "BIGINT", "DECIMAL")}[kind]
    v = F.try_parse_json(document)
    of_type = reduce(lambda a, b: a | b, [F.schema_of_variant(F.try_variant_get(v, path, "variant")).startswith(n) for n in names])
    return F.when(of_type, F.try_variant_get(v, path, kind))


def _without_urls(value, root: bool = True):
    if isinstance(value, dict):
        return {k: _without_urls(v, False) for k, v in value.items() if root and k == "html_url" or not (k == "url" or k.endswith("_url"))}
    return value


def drop_url_fields(document: Column) -> Column:
    """A JSON object without its fields ``url`` and ``*_url`` at any depth, but for ``html_url`` at the root; other texts unchanged."""

    def one(text):
        if text is None:
            return None
        try:
            value = json.loads(text)
        except ValueError:
            return text
        return json.dumps(_without_urls(value), separators=(",", ":")) if isinstance(value, dict) else text

    return F.pandas_udf(lambda s: s.map(one), T.StringType())(document)
