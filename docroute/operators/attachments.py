"""Attachment filters, default names, and ZIP audits on entry listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.functions import text as t

# Words that hint at an invoice when name and type say nothing.
INVOICE_HINT = r"(?iU)(invoice|inv\b|statement|bill|approved contractor|contractor invoice|remit|payment)"
NOT_FILES = "itemattachment|referenceattachment"
HAS_EXT = r"\.[A-Za-z0-9]{1,8}$"
PDF_MAGIC = "%PDF-"

# ZIP limits.
MAX_ENTRIES, MAX_ENTRY_BYTES, MAX_TOTAL_BYTES, MAX_RATIO = 200, 100 << 20, 500 << 20, 100


def is_file(odata_type) -> Column:
    return ~F.lower(t.blank(odata_type)).rlike(NOT_FILES)


def extension(name, content_type, subject) -> Column:
    n, ct = t.blank(name), F.lower(t.blank(content_type))
    own = F.lower(F.regexp_extract(n, r"(\.[A-Za-z0-9]{1,8})$", 1))
    return (
        F.when(own != "", own)
        .when(ct.contains("pdf"), ".pdf")
        .when(ct.contains("zip") | ct.contains("compressed"), ".zip")
        .when(F.lower(F.concat_ws(" ", n, t.blank(subject))).contains("zip"), ".zip")
        .otherwise(".pdf")
    )


def is_container(name, content_type, subject) -> Column:
    n, ct = t.strip(name), F.lower(t.blank(content_type))
    typed = n.rlike(r"(?iU)\.(pdf|zip)(\b|$)") | ct.contains("pdf") | ct.contains("zip") | ct.contains("compressed")
    untyped = ~n.rlike(HAS_EXT) & ((ct == "") | ct.contains("octet-stream"))
    return typed | (untyped & F.concat_ws(" ", n, t.blank(subject)).rlike(INVOICE_HINT))


def default_name(name, ext: Column) -> Column:
    n = t.strip(name)
    n = F.when(n == "", "file").otherwise(n)
    return F.when(n.rlike(HAS_EXT), n).otherwise(F.concat(n, ext))


def classified(attachments: DataFrame, messages: DataFrame) -> DataFrame:
    """Adds ext, base_name, kind (pdf | zip | extra) and is_real_pdf; pointers to other items are dropped."""
    if "odata_type" in attachments.columns:
        attachments = attachments.where(is_file("odata_type"))
    a = attachments.join(messages.select("msg_id", "subject"), "msg_id")
    ext = extension("name", "content_type", "subject")
    a = a.withColumns({"ext": ext, "is_container": is_container("name", "content_type", "subject")})
    return a.withColumns({
        "base_name": default_name("name", F.col("ext")),
        "kind": F.when(~F.col("is_container"), "extra").when(F.col("ext") == ".pdf", "pdf").when(F.col("ext") == ".zip", "zip").otherwise("extra"),
        "is_real_pdf": F.substring(F.col("head").cast("string"), 1, 5) == PDF_MAGIC,
    })


def routed_name(base_name: Column, plan: Column, also_spaced: bool = False) -> Column:
    """Prefix the plan unless the name already starts with it."""
    up = F.upper(base_name)
    starts = up.startswith(plan)
    if also_spaced:
        starts = starts | up.startswith(t.pretty_plan(plan))
    prefixed = t.safe_file_name(F.concat(t.pretty_plan(plan), F.lit(" - "), base_name))
    return F.when(starts, base_name if also_spaced else t.safe_file_name(base_name)).otherwise(prefixed)


# ---- ZIP entry listings

def zip_inner_name(zip_name: Column, leaf: Column) -> Column:
    """The routed name carries the archive's stem; matching sees the leaf only."""
    return F.concat(t.name_stem(zip_name), F.lit("__"), leaf)


def audit(entries: DataFrame) -> DataFrame:
    """One row per ZIP with the first violation in entry order, '' when safe.

    An archive over the entry limit is refused on its count alone, so running totals are only taken over
    groups of at most MAX_ENTRIES rows.
    """
    sizes = entries.groupBy("zip_id").agg(F.count("*").alias("n_entries"), F.sum("file_size").alias("total_bytes"))
    small = entries.join(sizes.where(F.col("n_entries") <= MAX_ENTRIES).select("zip_id"), "zip_id", "left_semi")
    w = Window.partitionBy("zip_id").orderBy("entry_no", "file_size", "compress_size", "entry_name").rowsBetween(Window.unboundedPreceding, 0)
    name = F.concat(F.lit("entry '"), "entry_name", F.lit("'"))
    ratio_over = F.col("file_size") > F.lit(MAX_RATIO) * F.greatest(F.col("compress_size"), F.lit(1))
    reason = (
        F.when(F.col("encrypted"), F.concat(F.lit("encrypted "), name))
        .when(F.col("file_size") > MAX_ENTRY_BYTES, F.concat(name, F.lit(" uncompressed size "), F.col("file_size").cast("string"), F.lit(f" > {MAX_ENTRY_BYTES}")))
        .when(ratio_over, F.concat(name, F.lit(" ratio "), F.col("file_size").cast("string"), F.lit("/"), F.greatest(F.col("compress_size"), F.lit(1)).cast("string"), F.lit(f" > {MAX_RATIO}")))
        .when(F.col("running") > MAX_TOTAL_BYTES, F.concat(F.lit("total uncompressed size "), F.col("running").cast("string"), F.lit(f" > {MAX_TOTAL_BYTES}")))
    )
    seen = small.withColumns({"running": F.sum("file_size").over(w), "nth": F.row_number().over(w)}).withColumn("reason", reason)
    first = seen.where("reason is not null").groupBy("zip_id").agg(F.min_by("reason", "nth").alias("reason"))
    too_many = F.concat(F.lit("too many entries ("), F.col("n_entries").cast("string"), F.lit(f" > {MAX_ENTRIES})"))
    return sizes.join(first, "zip_id", "left").withColumn(
        "reason", F.when(F.col("n_entries") > MAX_ENTRIES, too_many).otherwise(t.blank("reason")))


def _listed(entries: DataFrame) -> DataFrame:
    leaf = F.substring_index(F.replace("entry_name", F.lit("\\"), F.lit("/")), "/", -1)
    e = entries.withColumn("leaf", leaf).where(~F.col("is_dir") & (F.col("leaf") != "") & ~t.is_mac_metadata("entry_name"))
    low = F.lower("leaf")
    return e.withColumn("entry_kind", F.when(low.endswith(".pdf"), "pdf").when(low.endswith(".txt"), "companion").otherwise("other"))


def strict(entries: DataFrame) -> DataFrame:
    """One row per ZIP: audit violation, else the foreign entries, else the number of PDFs kept.

    The reason of a safe archive names each foreign leaf once; at most MAX_ENTRIES names can occur.
    """
    safe = audit(entries)
    e = _listed(entries).join(safe.where("reason = ''").select("zip_id"), "zip_id", "left_semi")
    g = e.groupBy("zip_id").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("entry_kind") == "other", F.col("leaf")))), ", ").alias("foreign"),
        F.count_if(F.col("entry_kind") == "pdf").alias("n_pdfs"),
    )
    out = safe.join(g, "zip_id", "left").withColumn(
        "reason", F.when(F.col("reason") != "", F.col("reason")).when(t.blank("foreign") != "", F.concat(F.lit("non-PDF entries: "), "foreign")).otherwise(""))
    return out.select("zip_id", "n_entries", "reason", F.when(F.col("reason") == "", F.coalesce("n_pdfs", F.lit(0))).otherwise(0).alias("n_kept"))


def strict_entries(entries: DataFrame, keep: list[str] | None = None, audited: DataFrame | None = None) -> DataFrame:
    """The PDF entries of ZIPs that pass A14, with the name matching sees, and the columns to keep. audited: `strict` of the entries, where it is at hand."""
    ok = (strict(entries) if audited is None else audited).where("reason = ''").select("zip_id")
    return _listed(entries).where("entry_kind = 'pdf'").join(ok, "zip_id", "left_semi").select("zip_id", "entry_no", "leaf", *(keep or []))


def lenient_entries(entries: DataFrame, extensions: tuple[str, ...] = (".pdf",)) -> DataFrame:
    """Recognised entries of ZIPs that pass the audit; everything else is ignored."""
    ok = audit(entries).where("reason = ''").select("zip_id")
    pattern = "(" + "|".join(e.replace(".", r"\.") for e in extensions) + ")$"
    return _listed(entries).where(F.lower("leaf").rlike(pattern)).join(ok, "zip_id", "left_semi").select("zip_id", "entry_no", "leaf")
