"""Rows out of stored web pages (url, html)."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraops.functions import text, time

#: Fixed: the classes of a catalog page's cells.
NAME_CELL, TEXT_CELL, TAGS_CELL = "ee-dataset", "ee-dataset-description-snippet", "ee-tag-buttons ee-small"


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, text, link): anchors that name folders, in capitals without a blank, or end in .zip."""
    found = F.explode(F.regexp_extract_all("html", F.lit(r"<a [^>]*>([^<]*)</a>"), 1)).alias("text")
    links = pages.select("page_id", "url", found)
    kept = links.where(text.is_folder_link(F.col("text")) | text.is_zip_link(F.col("text")))
    return kept.select("page_id", "text", F.concat("url", "text").alias("link"))


class _Cells(HTMLParser):
    """Cells of a page: dicts of tag, body (number of its tbody), class, text, hrefs and spans."""

    KEPT = ("td", "code", "dd")

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.cells: list[dict] = []
        self.open: list[dict] = []
        self.body = 0
        self.span: dict | None = None
        self.feed(html or "")
        self.close()

    def handle_starttag(self, tag, attrs):
        named = dict(attrs)
        if tag == "tbody":
            self.body += 1
        if tag in self.KEPT:
            cell = {"tag": tag, "body": self.body, "class": " ".join((named.get("class") or "").split()), "text": "", "hrefs": [], "spans": [], "bold": False}
            self.cells.append(cell)
            self.open.append(cell)
        elif self.open and tag == "a" and named.get("href"):
            self.open[-1]["hrefs"].append(named["href"])
        elif self.open and tag == "span":
            self.span = {"class": " ".join((named.get("class") or "").split()), "text": ""}
            self.open[-1]["spans"].append(self.span)
        elif self.open and tag == "b":
            self.open[-1]["bold"] = True

    def handle_endtag(self, tag):
        if tag == "span":
            self.span = None
        elif tag in self.KEPT and self.open:
            self.open.pop()

    def handle_data(self, data):
        if self.span is not None:
            self.span["text"] += data
        for cell in self.open:
            cell["text"] += data


def _rows(pages: DataFrame, make, schema: str) -> DataFrame:
    """make(url, cells) -> tuples of schema; a page that fails gives one row of nulls with its error."""
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for url, html in zip(batch.url, batch.html, strict=True):
                try:
                    out += [(url, *row, None) for row in make(_Cells(html).cells)]
                except (ValueError, IndexError, KeyError) as error:
                    out.append((url, *[None] * len(names), f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(out, columns=["url", *names, "error"])

    return pages.select("url", "html").mapInPandas(read, f"url string, {schema}, error string")


def _listed(cells: list[dict]) -> Iterator[tuple]:
    for body in dict.fromkeys(c["body"] for c in cells if c["tag"] == "td"):
        own = {c["class"]: c for c in cells if c["tag"] == "td" and c["body"] == body}
        name = own[NAME_CELL]["hrefs"][0].split("/")[-1]
        tags = list(dict.fromkeys(h.split("/")[-1] for h in own[TAGS_CELL]["hrefs"]))
        yield name, tags, own[TEXT_CELL]["text"]


LISTED = "dataset string, tags array<string>, description string"


def catalog_rows(pages: DataFrame) -> DataFrame:
    """(url, dataset, tags, description, error): one row per table body of a listing page."""
    return _rows(pages, _listed, LISTED)


def _detail(cells: list[dict]) -> Iterator[tuple]:
    yield next(c["text"] for c in [*cells, {"tag": "code", "text": None}] if c["tag"] == "code"), [c["text"] for c in cells if c["tag"] == "dd"]


DETAIL = "code string, dd array<string>"


def detail_rows(pages: DataFrame, strict: bool = False) -> DataFrame:
    """(url, dataset_id, dataset_type, dataset_start, dataset_end, error) of detail pages.

    The type and id come from the first <code>; the dates from the first <dd> that holds a range, else null.
    """
    found = _rows(pages, _detail, DETAIL)
    ranges = F.filter(F.transform("dd", lambda t: time.availability(t, strict)), lambda r: r.isNotNull())
    error = F.when(F.col("error").isNull() & F.col("code").isNull(), "no code").otherwise(F.col("error"))
    found = found.withColumn("c", text.code_block(F.col("code"))).withColumn("r", F.get(ranges, 0))
    return found.select("url", "c.dataset_id", "c.dataset_type", F.col("r.start").alias("dataset_start"), F.col("r.end").alias("dataset_end"), error.alias("error"))


def _place(cells: list[dict]) -> Iterator[tuple]:
    out = {"lat": 0.0, "lng": 0.0, "city": "", "region_name": "", "country_name": ""}
    for cell in (c for c in cells if c["tag"] == "td" and not c["bold"]):
        if cell["class"] in ("lat", "lng"):
            out[cell["class"]] = float(cell["text"])
        elif cell["class"] == "city":
            out["city"] = cell["text"].split(" ")[0]
        elif not cell["class"] and cell["spans"] and cell["spans"][0]["class"] in ("region_name", "country_name"):
            out[cell["spans"][0]["class"]] = cell["spans"][0]["text"]
    yield tuple(out.values())


PLACE = "lat double, lon double, city string, region string, country string"


def place_rows(pages: DataFrame) -> DataFrame:
    """(url, lat, lon, city, region, country, error) of key-value pages; 0 or '' where a cell is missing."""
    return _rows(pages, _place, PLACE)


def _table_function(make, schema: str):
    """make as a table function of a page's html, for LATERAL in SQL; a page that fails gives nulls and its error."""
    width = len(schema.split(", "))

    class Rows:
        def eval(self, html: str):
            try:
                yield from [(*row, None) for row in make(_Cells(html).cells)]
            except (ValueError, IndexError, KeyError) as error:
                yield (*[None] * width, f"{type(error).__name__}: {error}")

    return F.udtf(Rows, returnType=f"{schema}, error string")


def register_functions(spark: SparkSession) -> None:
    """Makes the extractors table functions of a page's html in SQL: listing_rows, detail_cells and place_cells."""
    for name, make, schema in (("listing_rows", _listed, LISTED), ("detail_cells", _detail, DETAIL), ("place_cells", _place, PLACE)):
        spark.udtf.register(name, _table_function(make, schema))
