"""Path templates like {subject_id}/{session_id}/{subject_id}_{session_date:date}_{task}, compiled to columns (SC5).

A field is text without a slash, or of a kind that its pattern and its conversion make: date, time or int, and what a caller
adds. A field that comes again must have the same text again. The template stands for the end of a path.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.sources import shared


class Kind(NamedTuple):
    pattern: str
    value: Callable[[Column], Column] = lambda c: c


KINDS = {
    "text": Kind("[^/]+?"),
    "date": Kind("[0-9]{4}-[0-9]{2}-[0-9]{2}", lambda c: F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date")),
    "time": Kind("[0-9]{2}-[0-9]{2}-[0-9]{2}", lambda c: F.date_format(F.try_to_timestamp(F.concat(F.lit("2000-01-01 "), c), F.lit("yyyy-MM-dd HH-mm-ss")), "HH:mm:ss")),
    "int": Kind("[0-9]+", lambda c: c.try_cast("bigint")),
}


class Template(NamedTuple):
    """strict: a pattern in which a field that comes again refers back; loose: one in which it is any text of its kind."""

    fields: tuple[tuple[str, str], ...]
    strict: str
    loose: str
    kinds: dict[str, Kind]


def compiled(template: str, kinds: dict[str, Kind] | None = None) -> Template:
    known = KINDS | (kinds or {})
    fields: dict[str, str] = {}
    strict, loose = [], []
    for literal, name, kind in re.findall(r"([^{}]*)(?:\{(\w+)(?::(\w+))?\})?", template):
        strict.append(re.escape(literal))
        loose.append(re.escape(literal))
        if not name:
            continue
        if name in fields:
            strict.append(f"\\{list(fields).index(name) + 1}(?![0-9])" if len(fields) > 8 else f"\\{list(fields).index(name) + 1}")
            loose.append(f"(?:{known[fields[name]].pattern})")
            continue
        fields[name] = kind or "text"
        if fields[name] not in known:
            raise ValueError(f"no kind of field {fields[name]}")
        strict.append(f"({known[fields[name]].pattern})")
        loose.append(f"(?:{known[fields[name]].pattern})")
    if not fields or len(fields) > 9 or "".join(re.findall(r"[{}]", re.sub(r"\{\w+(:\w+)?\}", "", template))):
        raise ValueError(f"not a template of one to nine fields: {template}")
    return Template(tuple(fields.items()), "(?:^|/)" + "".join(strict) + "$", "(?:^|/)" + "".join(loose) + "$", known)


def expand(listing: DataFrame, template: str | Template, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """The listing's rows with the template's fields as columns, and path and reason of those that don't fit: no match, fields
    disagree (one that comes again is another text), or a text that isn't of its field's kind."""
    t = compiled(template) if isinstance(template, str) else template
    # one match finds all fields; their text holds no null character unless the path does, and then each is matched for itself
    at_once = F.split(F.regexp_replace(path, f"^(?s:.*?){t.strict}", "\0".join(f"${i + 1}" for i in range(len(t.fields)))), "\0")
    each = F.array(*[F.regexp_extract(path, t.strict, i + 1) for i in range(len(t.fields))])
    texts = F.when(F.col(path).rlike(t.strict), F.when(F.contains(F.col(path), F.lit("\0")), each).otherwise(at_once))
    value = F.struct(*[t.kinds[kind].value(F.get("_texts", F.lit(i))).alias(name) for i, (name, kind) in enumerate(t.fields)])
    reason = F.when(F.col("_texts").isNull(), F.when(~F.col(path).rlike(t.loose), "no match").otherwise("fields disagree"))
    for name, kind in t.fields:
        reason = reason.when(F.col(f"_value.{name}").isNull(), f"{name} is no {kind}")
    read = listing.withColumn("_texts", texts).withColumn("_value", value)
    # written once: a filter on reason would put the matching into each of its terms, and both results read it
    judged = shared.written(read.withColumn("reason", F.when(F.col(path).isNull(), "no path").otherwise(reason)).drop("_texts"), "judged")
    found = judged.filter(F.col("reason").isNull()).drop("reason")
    own = {name: F.col(f"_value.{name}") for name, _ in t.fields}
    return found.withColumns(own).drop("_value"), judged.filter(F.col("reason").isNotNull()).select(path, "reason")
