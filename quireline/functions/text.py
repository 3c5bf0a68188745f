"""Scalar functions over names and texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quireline.functions.edits import edits


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The name without its last extension."""
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def extension(path: Column) -> Column:
    """The last extension in lower case with its dot, or nothing."""
    return F.lower(F.regexp_extract(basename(path), r"(\.[^.]*)$", 1))


def dispatch(path: Column) -> Column:
    """What splitting does with a file: split a PDF, copy an image, skip the rest, .tif among it."""
    name = F.lower(basename(path))
    return F.when(name.endswith(".pdf"), "split").when(name.rlike(r"\.(jpg|jpeg|png|bmp|tiff|gif)$"), "copy").otherwise("skip")


def is_ocr_input(path: Column) -> Column:
    return F.lower(basename(path)).rlike(r"\.(pdf|png|jpe?g|tiff?)$")


def is_image(path: Column) -> Column:
    return F.lower(basename(path)).rlike(r"\.(png|jpe?g|tiff?|bmp)$")


def page_name(path: Column, page_no: Column) -> Column:
    return F.concat(stem(path), F.lit("_page_"), page_no.cast("string"), F.lit(".pdf"))


def not_blank(text: Column) -> Column:
    """Holds a character that isn't white space of any script."""
    return F.coalesce(text, F.lit("")).rlike(r"(?U)\S")


def cer(hyp: Column, ref: Column, half_even: bool = True) -> Column:
    """Edits from the hypothesis to the reference by code points, a share of the reference's length; 0 without a reference.

    Rounded to 6 digits, half to even unless told otherwise; it may be over 1.
    """
    n = F.length(ref)
    share = edits(F.coalesce(hyp, F.lit("")), ref) / n
    return F.when(n > 0, (F.bround if half_even else F.round)(share, 6)).otherwise(F.lit(0.0))


def languages(text: Column) -> Column:
    """'rus+eng' or 'rus,eng' as an array; English where nothing is said."""
    found = F.filter(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), ",", "+"), r"\+"), lambda x: x != "")
    return F.when(F.size(found) == 0, F.array(F.lit("eng"))).otherwise(found)


def reader_languages(text: Column) -> Column:
    """Codes of an OCR reader: ru where Russian is named, en where English is, en where neither is."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = F.array_compact(F.array(F.when(low.contains("rus"), "ru"), F.when(low.contains("en"), "en")))
    return F.when(F.size(found) == 0, F.array(F.lit("en"))).otherwise(found)


def pages_joined(page_no: Column, text: Column) -> Column:
    """Aggregate: a document's page texts in page order, form feeds between them."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(page_no.alias("n"), F.coalesce(text, F.lit("")).alias("t")))), lambda x: x["t"]), "\f")


def response_text(body: Column, content_type: Column) -> Column:
    """The text of a service's answer: the field of a JSON body, or the body itself."""
    return F.when(F.coalesce(content_type, F.lit("")).contains("json"), F.coalesce(F.get_json_object(body, "$.text"), F.lit(""))).otherwise(body)


def data_url(jpeg: Column) -> Column:
    return F.concat(F.lit("data:image/jpeg;base64,"), F.base64(jpeg))


def odd(n: Column) -> Column:
    return n + (1 - n % 2)
