"""Path helpers as native column expressions (H4-H8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parent_dir(path: Column | str) -> Column:
    """H4: everything before the last ``/``; ``""`` when there is no slash."""
    return F.regexp_extract(_c(path), r"^(.*)/[^/]*$", 1)


def file_name(path: Column | str) -> Column:
    """H4: everything after the last ``/`` (the whole path without one)."""
    return F.substring_index(_c(path), "/", -1)


def strip_extension(name: Column | str) -> Column:
    """H5: drop the last ``.ext``; leading dots belong to the name."""
    n = _c(name)
    stem = F.regexp_extract(n, r"^(\.*[^.].*)\.[^.]*$", 1)
    return F.when(stem == "", n).otherwise(stem)


def pad5(n: Column | str) -> Column:
    """Zero-padded to at least five digits; longer numbers are kept whole."""
    return F.format_string("%05d", _c(n))


def page_path_prefix(pdf_path: Column | str) -> Column:
    """H6 up to the page number: ``{parent}/{base}/{base}-page-``. Depends on
    the document only, so it is computed once before pages are generated."""
    p = _c(pdf_path)
    parent = parent_dir(p)
    base = strip_extension(file_name(p))
    folder = F.when(parent == "", base).otherwise(F.concat(parent, F.lit("/"), base))
    return F.concat(folder, F.lit("/"), base, F.lit("-page-"))


def page_path_from_prefix(prefix: Column | str, page_number: Column | str) -> Column:
    return F.concat(_c(prefix), pad5(page_number), F.lit(".png"))


def page_object_path(pdf_path: Column | str, page_number: Column | str) -> Column:
    """H6: ``{parent}/{base}/{base}-page-{n:05d}.png`` (no parent: ``{base}/...``)."""
    return page_path_from_prefix(page_path_prefix(pdf_path), page_number)


def page_id(doc_id: Column | str, page_number: Column | str) -> Column:
    """H7: ``{doc_id}_{n:05d}``."""
    return F.concat(_c(doc_id), F.lit("_"), pad5(page_number))


# Folder-name descriptions used for the summary header.
DESCRIPTIONS = {
    "1. International Standards": "Includes international standard and specification documents required for high voltage circuit breaker design and testing. Refer to the technical specifications of global standardization organizations such as IEC and IEEE. Required data for product development and design standard establishment.",
    "IEC": "Standard and specification documents on high-voltage equipment issued by the International Conference on Electrical Standards (IEC). Provide global standards for design, testing, safety standards, etc.",
    "IEEE": "The American Institute of Electrical and Electronics (IEEE) specifications and standards, including market-focused design standards and testing procedures in North America.",
    "2. Type Test Reports": "This is the type test result report of the actual manufactured circuit breaker. It is classified by model and year and details test items, insulation performance, and blocking performance.",
    "145SP-3": "Type test data for circuit breaker model 145SP-3.",
    "145 kV 40 kA MS (2017)": "A test report of a 145kV / 40kA class circuit breaker tested in 2017 of the model 145SP-3.",
    "300SR": "Type test data for circuit breaker model 300SR.",
    "245 kV 50 kA MS (2020)": "Test report of 245kV / 50kA circuit breaker tested in 2020 of Model 300SR.",
    "245 kV 63 kA MS (2024)": "Test report of 245kV / 63kA circuit breaker carried out in 2024 of Model 300SR.",
    "3. Customer Standard Specifications": "Standard Specifications by Country/Power Authority/Consumer.\nStandard Specification document provided by each country and customer. Refer to when delivering the product if you need a design that reflects customer requirements. This may include local application regulations and special requirements.",
    "Endeavour Energy": "Standard specifications of Endeavour Energy, Power company in Australia.",
    "OETC": "Standard specifications of OETC, Power company in Oman.",
    "SEC": "Standard specifications of SEC, Power company in Saudi Arabia.",
    "Iberdrola": "Standard specifications of Iberdrola, Power company in Spain.",
    "REE": "Standard specifications of REE, Power company in Spain.",
}


def description_map(mapping: dict[str, str] | None = None) -> Column:
    m = DESCRIPTIONS if mapping is None else mapping
    if not m:
        return F.create_map().cast("map<string,string>")
    kv = []
    for k, v in m.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def path_description(path: Column | str, mapping: dict[str, str] | None = None) -> Column:
    """H8: look up every ``/`` component, ``""`` when missing, joined by newline.

    ``mapping`` is a bounded dict compiled into a map literal (no join, no
    shuffle). For a description table of unbounded size use
    :func:`path_description_join`.
    """
    m = description_map(mapping)
    parts = F.split(_c(path), "/", -1)
    return F.array_join(F.transform(parts, lambda k: F.coalesce(m[k], F.lit(""))), "\n")


def path_description_join(df: DataFrame, path_col: str, descriptions: DataFrame,
                          out_col: str = "description") -> DataFrame:
    """H8 against a description table ``(path_key, description)`` of any size.

    Components are exploded with their position, joined to the table (AQE
    broadcasts it only when its measured size is under the threshold), and
    put back in order per distinct path. A path has few components, so the
    regroup is bounded per key.
    """
    paths = df.select(F.col(path_col).alias("_p")).distinct()
    parts = paths.select("_p", F.posexplode(F.split("_p", "/", -1)).alias("_pos", "_k"))
    d = descriptions.select(F.col("path_key").alias("_k"), F.col("description").alias("_d"))
    d = d.groupBy("_k").agg(F.max("_d").alias("_d"))
    hit = parts.join(d, "_k", "left")
    per_path = hit.groupBy("_p").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("_d", F.lit(""))
                                                             .alias("_d")))),
                        lambda s: s["_d"]), "\n").alias(out_col))
    return df.join(per_path, df[path_col] == per_path["_p"], "left").drop("_p")
