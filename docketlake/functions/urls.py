"""Addresses and paths of daily digests as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DEFAULT_OUTPUT = "raw"


def _parts(day: Column) -> tuple[Column, Column, Column]:
    year = F.year(day)
    stem = F.concat(F.lit("dig"), F.date_format(day, "MMddyy"))
    late_2002 = (year == 2002) & (F.month(day) >= 2)
    return year, stem, late_2002


def file_extension(day: Column) -> Column:
    """Format by era: pdf up to January 2002, txt up to 2006, then htm."""
    year, _, late_2002 = _parts(day)
    return (
        F.when(year >= 2007, F.lit("htm"))
        .when((year >= 2003) | late_2002, F.lit("txt"))
        .otherwise(F.lit("pdf"))
    )


def digest_url(day: Column, base: str) -> Column:
    """The address expected for a day. ``base`` is the archive's root address."""
    year, stem, late_2002 = _parts(day)
    name = F.when(late_2002, F.date_format(day, "MM-dd")).otherwise(stem)
    in_root = year.between(2003, 2006) | late_2002
    folder = F.when(in_root, F.lit("")).otherwise(F.concat(year.cast("string"), F.lit("/")))
    return F.concat(F.lit(f"{base}/"), folder, name, F.lit("."), file_extension(day))


def local_path(day: Column, output: str = DEFAULT_OUTPUT) -> Column:
    """``output/YYYY/digest_YYYY-MM-DD.ext`` with the extension of the expected address."""
    return F.concat(
        F.lit(f"{output}/"), F.date_format(day, "yyyy"), F.lit("/digest_"),
        F.date_format(day, "yyyy-MM-dd"), F.lit("."), file_extension(day),
    )


def candidate_urls(day: Column, base: str) -> Column:
    """Addresses to try for a day, best first, without repeats."""
    year, stem, late_2002 = _parts(day)

    def address(in_year: bool, ext: str) -> Column:
        folder = [year.cast("string"), F.lit("/")] if in_year else []
        return F.concat(F.lit(f"{base}/"), *folder, stem, F.lit(f".{ext}"))

    # The order of places to look, by era.
    year_pdf, root_pdf = address(True, "pdf"), address(False, "pdf")
    year_txt, root_txt = address(True, "txt"), address(False, "txt")
    year_htm, root_htm = address(True, "htm"), address(False, "htm")
    month_day = F.concat(F.lit(f"{base}/"), F.date_format(day, "MM-dd"), F.lit(".txt"))
    return F.array_distinct(
        F.when(late_2002, F.array(month_day))
        .when(year <= 2002, F.array(year_pdf, root_pdf))
        .when(year <= 2006, F.array(root_txt, year_txt, year_htm, root_htm))
        .when(year <= 2008, F.array(year_txt, root_txt, year_htm, root_htm))
        .otherwise(F.array(year_htm, year_txt, root_txt, root_htm))
    )


def digest_date_from_name(name: Column) -> Column:
    """The date in a ``digest_YYYY-MM-DD`` file name, null when it is malformed."""
    stem = F.regexp_replace(F.regexp_extract(name, r"([^/]*)$", 1), r"\.[^.]*$", "")
    text = F.regexp_extract(F.replace(stem, F.lit("digest_"), F.lit("")),
                            r"^(\d{4}-\d{1,2}-\d{1,2})$", 1)
    return F.try_to_date(text, "yyyy-M-d")


def file_suffix(path: Column) -> Column:
    """Lower-cased suffix with its dot, empty when there is none."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def source_kind(path: Column) -> Column:
    """How a raw file is read: ``pdf``, ``text``, ``html`` or ``unsupported``."""
    suffix = file_suffix(path)
    return (
        F.when(suffix == ".pdf", F.lit("pdf"))
        .when(suffix == ".txt", F.lit("text"))
        .when(suffix.isin(".htm", ".html"), F.lit("html"))
        .otherwise(F.lit("unsupported"))
    )


def year_folder(path: Column) -> Column:
    """Name of the parent folder when it is a whole number, else ``unknown``."""
    parent = F.regexp_extract(path, r"([^/]*)/[^/]*$", 1)
    number = F.regexp_extract(parent, r"^([+-]?\d+)$", 1).try_cast("bigint")
    return F.coalesce(number.cast("string"), F.lit("unknown"))


def text_path(path: Column, output: str) -> Column:
    """Where the text of a raw file goes: the same stem with ``.md`` in its year folder."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    return F.concat(F.lit(f"{output}/"), year_folder(path), F.lit("/"), stem, F.lit(".md"))


# --- archive links -----------------------------------------------------------

# What an archive link looks like.
PDF_LINK = r"(?i)\.pdf$"
DIGEST_LINK = r"/news/digest/(\d{4})/dig(\d{6})\.pdf"
YEAR_INDEX_LINK = r"/\d{4}/$|/\d{4}$"


def digest_link_parts(url: Column) -> Column:
    """``struct<year, month, day, yy>`` of an archive link, null when it is none."""
    year = F.regexp_extract(url, DIGEST_LINK, 1)
    code = F.regexp_extract(url, DIGEST_LINK, 2)
    return F.when(year != "", F.struct(
        year.cast("int").alias("year"),
        F.substring(code, 1, 2).alias("month"),
        F.substring(code, 3, 2).alias("day"),
        F.substring(code, 5, 2).alias("yy"),
    ))
