"""Raw files of many shapes as one shape: a row a record, its fields a map of strings.

Files come as rows (url, body), as ``binaryFile`` gives them; a broken file has no records and an error instead of
stopping the others. All but CSV, whose quoting spans lines, and XML, whose namespaces and entities need a parser, is read
by built-in expressions."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import bound, iso_date, strip

_ROWS = pa.schema([("url", pa.string()), ("at", pa.int32()), ("record", pa.map_(pa.string(), pa.string())), ("error", pa.string())])
_ROWS_SQL = "url string, at int, record map<string,string>, error string"


#: Files that a Python worker is handed at once, and records that it holds before it hands them on, at most.
FILES, HELD = 1000, 2000


def _few_files(spark: SparkSession) -> None:
    """Files are long rows: Spark's usual batch of 10,000 is as much as a worker's memory can be."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= FILES:
        spark.conf.set(name, str(FILES))


def _each(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Three values of each row, none for columns that are not named; only that row's are Python objects."""
    for batch in batches:
        held = [batch.column(c) for c in columns]
        for i in range(batch.num_rows):
            yield (*(c[i].as_py() for c in held), *[None] * (3 - len(held)))


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("url"), F.col("content").alias("body"))


def text_of(body: Column) -> Column:
    """UTF-8 text without a byte-order mark."""
    return F.regexp_replace(F.decode(body, "UTF-8"), "^﻿", "")


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _as_text(v: Column) -> Column:
    """A JSON value as text: whole numbers with a fraction keep it (1.0), objects and lists are JSON, null is none."""
    kind, plain = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
    fraction = kind.rlike(r"^DECIMAL\((\d|1[0-8]),0\)$")
    return F.when(kind == "VOID", None).when(fraction, F.concat(plain, F.lit(".0"))).otherwise(F.coalesce(plain, F.to_json(v)))


def _parsed(files: DataFrame) -> DataFrame:
    """url, text and v: the file's JSON, parsed once; null where it is none. Of keys that an object repeats the last counts."""
    files.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return files.select("url", text_of(F.col("body")).alias("text")).withColumn("v", F.try_parse_json("text"))


def _split(files: DataFrame, records: Column, more: dict[str, Column] | None = None) -> DataFrame:
    """url, at, record, error, raw: an element of records (a list of variants) that is no object costs itself only."""
    extra = [F.create_map(*(x for name, v in more.items() for x in (F.lit(name), v))).alias("_more")] if more else []
    each = files.select("url", *extra, records.isNull().alias("_none"), F.posexplode_outer(records).alias("at", "r"))
    good = _is(F.col("r"), "OBJECT")
    record = F.transform_values(F.try_variant_get(F.when(good, F.col("r")), "$", "map<string,variant>"), lambda _, v: _as_text(v))
    record = F.map_concat(record, "_more") if more else record
    error = F.when(F.col("_none"), "unreadable").when(F.col("at").isNotNull() & ~good, "not_an_object")
    return each.select("url", "at", record.alias("record"), error.alias("error"), F.when(error == "not_an_object", F.to_json("r")).alias("raw"))


def _list_of(v: Column) -> Column:
    return F.try_variant_get(F.when(_is(v, "ARRAY"), v), "$", "array<variant>")


def json_records(files: DataFrame, paths: tuple[str, ...]) -> DataFrame:
    """The records under the first path that holds a list; a bare list, or one bare object, where no path is given."""
    v = F.col("v")
    parts = [_list_of(F.try_variant_get(v, f"$.{p}", "variant")) for p in paths]
    one = [F.when(_is(v, "OBJECT"), F.array(v))] if not paths else []
    return _split(_parsed(files), F.coalesce(*parts, _list_of(v), *one))


def envelope_records(files: DataFrame) -> DataFrame:
    """The records of an unknown envelope: a usual key, else its first value in the file, else the list itself."""
    text = F.col("text")
    usual = [F.get_json_object(text, f"$.{k}") for k in ("pacientes", "patients", "data", "results", "items")]
    first = F.get(F.map_values(F.from_json(text, "map<string,string>")), F.lit(0))
    inside = F.try_parse_json(F.coalesce(*usual, first))
    return _split(_parsed(files), F.coalesce(_list_of(F.col("v")), _list_of(inside)))


def nested_rows(files: DataFrame, rows: str, parent: dict[str, str]) -> DataFrame:
    """Records under rows, each with values of the parent: name -> path."""
    under = lambda p: F.try_variant_get(F.col("v"), f"$.{p}", "variant")
    return _split(_parsed(files), _list_of(under(rows)), {name: F.coalesce(_as_text(under(p)), F.lit("")) for name, p in parent.items()})


#: The namespace of person files and the elements of a person and of a note that are read.
PFIF = "http://zesty.ca/pfif/1.4/"
PERSON_ELEMENTS = ("person_record_id", "entry_date", "source_name", "source_url", "source_date", "full_name", "age", "photo_url")
NOTE_ELEMENTS = ("status", "text")


def pfif_records(files: DataFrame, anywhere: bool) -> DataFrame:
    """url, at, record, error of XML files: person elements of the PFIF namespace under any prefix, those right under the
    root or anywhere; note_ fields come from a person's first note. An XML parser reads a file as a whole: one that is
    not well-formed (cut off, unbound prefixes) has no records, comments and other namespaces count for nothing, and
    CDATA and entities are text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for url, body, _ in _each(batches, "url", "body"):
            try:
                root = ElementTree.fromstring(body or b"")
            except (ElementTree.ParseError, LookupError, ValueError) as e:  # also an encoding that nobody knows
                yield pa.RecordBatch.from_pylist([{"url": url, "error": type(e).__name__}], schema=_ROWS)
                continue
            rows = []
            for at, person in enumerate(root.findall(f"{'.//' if anywhere else ''}{{{PFIF}}}person")):
                note = person.find(f"{{{PFIF}}}note")
                get = lambda where, name: (where.findtext(f"{{{PFIF}}}{name}") or "") if where is not None else ""
                record = {n: get(person, n) for n in PERSON_ELEMENTS} | {f"note_{n}": get(note, n) for n in NOTE_ELEMENTS}
                rows.append({"url": url, "at": at, "record": list(record.items()), "error": None})
            yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)

    _few_files(files.sparkSession)
    return files.select("url", "body").mapInArrow(run, _ROWS_SQL)


def tag(name: str, css: str | None = None) -> str:
    """A pattern of an opening tag, of a class if one is given, whatever its other attributes are."""
    return rf"<{name}\b" + (rf"(?=[^>]*\bclass\s*=\s*[\"'][^\"'>]*(?<![\w-]){css}(?![\w-]))" if css else "") + "[^>]*>"


def card_records(text: Column, card: tuple[str, str], label: tuple[str, str | None], value: tuple[str, str | None], heads: dict[str, str]) -> Column:
    """HTML cards, elements (name, class), as maps: the text of each label element, lower-case, with that of the value
    element after it (the last of a label wins); heads: further fields, each by a pattern over the whole card whose
    group is the text."""
    cards = F.regexp_extract_all(text, F.lit(f"(?is){tag(*card)}.*?</{card[0]}\\s*>"), F.lit(0))
    pair = F.lit(f"(?is){tag(*label)}([^<]*)</{label[0]}\\s*>\\s*{tag(*value)}([^<]*)<")

    def one(c: Column) -> Column:
        keys, values = (F.transform(F.regexp_extract_all(c, pair, F.lit(k)), strip) for k in (1, 2))
        pairs = F.arrays_zip(F.transform(keys, F.lower).alias("k"), values.alias("v"))
        last = bound(pairs, lambda ps: F.filter(ps, lambda e, i: (e["k"] != "") & ~F.exists(F.slice(ps, i + 2, F.size(ps)), lambda later: later["k"] == e["k"])))
        named = [F.struct(F.lit(f"#{n}").alias("k"), strip(F.regexp_extract(c, p, 1)).alias("v")) for n, p in heads.items()]
        return F.map_from_entries(F.concat(last, F.array(*named)))

    return F.transform(cards, one)


def longest_line(text: Column) -> Column:
    lines = F.split(text, "\r\n|\n|\r")
    longest = F.array_max(F.transform(lines, F.length))
    return F.get(F.filter(lines, lambda x: F.length(x) == longest), F.lit(0))


def stream_records(text: Column) -> Column:
    """People of a component stream: flat or once-nested objects with a firstName. A hospital object becomes
    hospital.name and hospital.location; a reference ($...) counts as none."""
    objects = F.regexp_extract_all(text, F.lit(r'\{[^{}]*"firstName"(?:[^{}]|\{[^{}]*\})*\}'), F.lit(0))

    def one(o: Column) -> Column:
        flat = F.from_json(o, "map<string,string>")
        get = lambda p: F.coalesce(F.get_json_object(o, p), F.lit(""))
        return F.map_concat(F.map_filter(flat, lambda k, v: (k != "hospital") & v.isNotNull()), F.create_map(F.lit("hospital.name"), get("$.hospital.name"), F.lit("hospital.location"), get("$.hospital.location"), F.lit("hospital.known"), F.when(get("$.hospital").startswith("{"), "yes").otherwise("")))

    return F.transform(objects, one)


#: What a CSV file may raise that is not as it should be.
CSV_ERRORS = (UnicodeDecodeError, csv.Error, AttributeError)


def csv_rows(body: bytes, marker: str | None, case: str | None = None) -> Iterator[tuple[int, dict[str, str]]]:
    """Number and fields of each row under the header, the first row with a cell that holds the marker, or without a
    marker the first of three or more non-empty cells, all under 60 characters, else row 0; short rows are padded."""
    rows = list(csv.reader(io.StringIO(body.decode("utf-8-sig"), newline="")))
    top = None if marker else 0
    for i, row in enumerate(rows):
        cells = [c for c in row if c.strip()]
        if any(marker in c.upper() for c in cells) if marker else len(cells) >= 3 and all(len(c) < 60 for c in cells):
            top = i
            break
    names = [getattr(c.strip(), case)() if case else c.strip() for c in rows[top]] if top is not None and rows else []
    for k, row in enumerate(rows[top + 1 :] if names else []):
        if any(c.strip() for c in row):
            yield k, {n: c.strip() for n, c in zip(names, row + [""] * len(names), strict=False) if n}


def csv_records(files: DataFrame, marker: str | None, case: str | None = None) -> DataFrame:
    """url, at, record, error of CSV files, as csv_rows reads them. case: "upper" or "lower" for the names. A column label
    of files goes into each record as _sheet."""
    labelled = "label" in files.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {n: [] for n in _ROWS.names}

        def put(*values) -> None:
            for n, v in zip(_ROWS.names, values, strict=True):
                out[n].append(v)

        def taken() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict(out, schema=_ROWS)
            for values in out.values():
                values.clear()
            return made

        for url, body, label in _each(batches, "url", "body", *["label"] * labelled):
            more = {"_sheet": label or "unknown"}
            try:
                for k, record in csv_rows(body, marker, case):
                    put(url, k, list((record | more).items()), None)
                    if len(out["url"]) >= HELD:
                        yield taken()
            except CSV_ERRORS as e:
                put(url, None, None, type(e).__name__)
        yield taken()

    _few_files(files.sparkSession)
    return files.select("url", "body", *["label"] * labelled).mapInArrow(run, _ROWS_SQL)


def exploded(files: DataFrame, records: Column) -> DataFrame:
    """url, at, record, error: files without readable records have one row with an error."""
    rows = files.select("url", F.posexplode_outer(records).alias("at", "record"), records.isNull().alias("_none"))
    return rows.select("url", "at", "record", F.when(F.col("_none"), "unreadable").alias("error"))


def numbered_list(text: Column) -> Column:
    """name, place, date of a line such as ``12. Name (Place, 28-06-26)``, null of others: the number ends at the first
    dot, the place begins after the first bracket that a comma and a date alone follow."""
    def entry(line: Column, rest: Column, inside: Column) -> Column:
        good = F.substring_index(line, ".", 1).rlike("^[0-9]+$") & (inside != "") & rest.rlike(r"^\s")

        def named(name: Column) -> Column:
            part = lambda c: F.when(good & (name != ""), strip(c))
            return F.struct(part(name).alias("name"), part(F.substring_index(inside, ",", 1)).alias("place"), part(iso_date(strip(F.substring_index(inside, ",", -1)))).alias("date"))

        return bound(strip(F.substr(rest, F.lit(1), F.length(rest) - F.length(inside) - 2)), named)

    place = r"[ \t]+[(]([^,]+,[ \t]*[0-9-]+)[)]$"
    after = lambda line: bound(F.substr(line, F.locate(".", line) + 1), lambda rest: bound(F.regexp_extract(rest, place, 1), lambda inside: entry(line, rest, inside)))
    return bound(strip(text), after)
