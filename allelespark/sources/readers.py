"""Text and result-table readers.  Wide files are parsed as lines, never as thousands of CSV columns.

A path may name many files.  Each is read by its own header; a file without one continues the file before it, as the parts of a
folder do whose header stands only in the first.  Headers are found by opening the first lines of each file, through Spark's file
systems and codecs, some files at a time; what is read for them doesn't grow with the files.  Only covariates that may have junk before
their header take a pass over all lines.
"""
from __future__ import annotations

import csv
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelespark.operators.clean import harmonise, sample_key, strip_version, to_number
from allelespark.operators.ordered import first_rows

NA_TOKENS = ("NA", "NaN", "")  # fixed values: cells read as missing
ID_HEADERS = ("sample", "sample_id", "id", "iid")  # fixed values: first headers that mark sample rows
FAM = "fid STRING, sample_id STRING, pid STRING, mid STRING, sex INT, phenotype DOUBLE"
BIM = "chrom STRING, variant_id STRING, cm DOUBLE, pos BIGINT, allele1 STRING, allele2 STRING"


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and their place: (value, _file, _at)."""
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return lines(spark, path).select("value", file.alias("_file"), F.struct(file, start, F.monotonically_increasing_id()).alias("_at"))


Headers = list[tuple[str, list[str]]]


def file_headers(raw: DataFrame, own: Column, same: Callable[[Column, Column], Column] | None = None) -> Headers:
    """Distinct headers in path order, each with its files.

    ``own`` aggregates a file's lines to what may be its header; it is one if ``same(it, the first file's)``.
    """
    path = Window.orderBy("_file")  # one row per file
    heads = raw.groupBy("_file").agg(own.alias("_own"))
    heads = heads.withColumn("_lead", F.first("_own", True).over(path.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    if same is not None:
        heads = heads.withColumn("_own", F.when(same(F.col("_own"), F.col("_lead")), F.col("_own")))
    heads = heads.select("_file", F.coalesce(F.last("_own", True).over(path), F.col("_lead")).alias("head")).where("head IS NOT NULL")
    rows = heads.groupBy("head").agg(F.sort_array(F.collect_list("_file")).alias("files")).collect()
    return sorted(((x.head, x.files) for x in rows), key=lambda x: x[1][0])


def first_lines(spark: SparkSession, path: str, wanted: Callable[[str], bool | None]) -> list[tuple[str, str | None]]:
    """Each file with its first line that is ``wanted``; None from ``wanted`` ends the search in a file."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def open_one(file: str) -> tuple[str, str | None]:
        path_of = jvm.org.apache.hadoop.fs.Path
        where = path_of(path_of(jvm.java.net.URI(file)).toString())
        name = where.toUri().toString()  # as the rows' metadata has it
        stream, codec = where.getFileSystem(conf).open(where), codecs.getCodec(where)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
        try:
            while (line := reader.readLine()) is not None:
                found = wanted(line)
                if found is None:
                    return name, None
                if found:
                    return name, line
            return name, None
        finally:
            reader.close()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(open_one, sorted(spark.read.text(path).inputFiles())))


def file_heads(
    spark: SparkSession, path: str, wanted: Callable[[str], bool | None] = lambda line: True, same: Callable[[str, str], bool] = lambda own, lead: True
) -> Headers:
    """Distinct headers in path order, each with its files: the ``wanted`` line of a file if ``same(it, the first file's)``."""
    found = first_lines(spark, path, wanted)
    lead = head = next((line for _, line in found if line is not None), None)
    heads: dict[str, list[str]] = {}
    for file, line in found:
        if line is not None and same(line, lead):
            head = line
        if head is not None:
            heads.setdefault(head, []).append(file)
    return list(heads.items())


def first_of_file() -> Column:
    return F.min_by("value", "_at")


def same_label(own: Column, lead: Column) -> Column:
    """Whether two lines have the same first cell."""
    label = lambda c: F.regexp_extract(c, r"^[^\t,; ]*", 0)
    return label(own) == label(lead)


def _label(line: str) -> str:
    return re.match(r"[^\t,; ]*", line).group()


def label_is(own: str, lead: str) -> bool:
    """Whether two lines have the same first cell."""
    return _label(own) == _label(lead)


def need(heads: Headers, path: str) -> Headers:
    if not heads:
        raise ValueError(f"no header in {path}")
    return heads


def numbered(rows: DataFrame, heads: Headers) -> DataFrame:
    """``rows`` with ``_h``, the number of their file's header."""
    if len(heads) == 1:
        return rows.withColumn("_h", F.lit(0))
    files = [(h, f) for h, (_, names) in enumerate(heads) for f in names]
    return rows.join(rows.sparkSession.createDataFrame(files, "_h INT, _file STRING"), "_file")


def named_cells(rows: DataFrame, names: list[list[str]], heads: Headers) -> DataFrame:
    """One row per element of ``cells``, with the sample name that the file's own header gives its place."""
    flat = [(h, i, n) for h, own in enumerate(names) for i, n in enumerate(own)]
    index = rows.sparkSession.createDataFrame(flat, "_h INT, i INT, sample_id STRING")
    rows = numbered(rows, heads)
    cells = rows.select(*[c for c in rows.columns if c not in ("cells", "_file")], F.posexplode("cells").alias("i", "cell"))
    return cells.join(index, ["_h", "i"]).drop("_h", "i")


def separated(raw: DataFrame, sep: str | None, path: str, notes: str | None = None) -> DataFrame:
    """Placed lines as string columns, without their headers; files may order their columns differently.

    Lines that start with ``notes`` are no headers.
    """
    cells = lambda line: sorted(re.split(r"[\t,]", line))
    heads = need(file_heads(raw.sparkSession, path, lambda x: not (notes and x.startswith(notes)), lambda own, lead: cells(own) == cells(lead)), path)
    sep = sep or sniff(heads[0][0], ("\t", ","))
    out = None
    for head, files in heads:
        names = next(csv.reader([head], delimiter=sep))
        body = raw.where((F.col("value") != head) & (F.trim("value") != ""))
        body = body if len(heads) == 1 else body.where(F.col("_file").isin(files))
        ddl = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
        part = body.select(F.from_csv("value", ddl, {"sep": sep}).alias("_r")).select("_r.*")
        out = part if out is None else out.unionByName(part)
    return out


def header_line(spark: SparkSession, path: str) -> str:
    """First line of the first file that has one; only first lines are read."""
    return need(file_heads(spark, path), path)[0][0]


def sniff(header: str, choices: Sequence[str] = ("\t", ",", " ")) -> str:
    return next((c for c in choices if c in header), choices[0])


# ---- VCF ----


def vcf_headers(spark: SparkSession, path: str) -> Headers:
    """``#CHROM`` lines; a file whose first line that isn't ``##`` is a record has none."""
    return file_heads(spark, path, lambda line: line.startswith("#CHROM") or (False if line.startswith("#") or not line else None))


def _vcf_names(heads: Headers) -> list[list[str]]:
    return [head.split("\t")[9:] for head, _ in heads]


def vcf_samples(spark: SparkSession, path: str) -> list[str]:
    """Sample names of all ``#CHROM`` lines (columns 10 on), each once, in the order they appear."""
    return list(dict.fromkeys(n for own in _vcf_names(vcf_headers(spark, path)) for n in own))


def vcf_fixed(raw: DataFrame, *keep: str) -> DataFrame:
    """Fixed columns, INFO as a map, and the sample cells still as one array."""
    c = F.split("value", "\t")
    body = raw.where(~F.startswith("value", F.lit("#")))
    return body.select(
        c[0].alias("chrom"), c[1].cast("bigint").alias("pos"), c[2].alias("variant_id"), c[3].alias("ref"), c[4].alias("alt"),
        to_number(c[5]).alias("qual"), c[6].alias("filter"), info_map(c[7]).alias("info"), F.split(c[8], ":").alias("format"),
        F.slice(c, 10, F.size(c)).alias("cells"), *keep,
    )


def info_map(info: Column) -> Column:
    return F.str_to_map(info, F.lit(";"), F.lit("="))


def info_field(info: Column, key: str) -> Column:
    """INFO value by key, a dot as null."""
    return F.nullif(F.try_element_at(info, F.lit(key)), F.lit("."))


def _field(cell: Column, format_: Column, name: str) -> Column:
    at = F.array_position(format_, name).cast("int")
    return F.when(at > 0, F.try_element_at(F.split(cell, ":"), at))


def cell_dosage(cell: Column, format_: Column) -> Column:
    """DS if present, else the number of ALT alleles in GT; an uncalled GT is null."""
    gt = F.split(_field(cell, format_, "GT"), r"[|/]")
    alt = F.size(F.filter(gt, lambda a: a != "0")).cast("double")
    return F.coalesce(to_number(_field(cell, format_, "DS")), F.when(~F.array_contains(gt, "."), alt))


def vcf_long(spark: SparkSession, path: str) -> DataFrame:
    """One row per variant and sample."""
    raw = placed_lines(spark, path)
    heads = need(vcf_headers(spark, path), path)
    cells = named_cells(vcf_fixed(raw, "_file"), _vcf_names(heads), heads)
    out = cells.withColumns({"gt": _field(F.col("cell"), F.col("format"), "GT"), "dosage": cell_dosage(F.col("cell"), F.col("format"))})
    return out.drop("cell", "format")


def vcf_dosages(spark: SparkSession, path: str) -> DataFrame:
    """One row per variant with dosages as an array in the order of ``vcf_samples``: no explode and no shuffle."""
    raw = placed_lines(spark, path)
    heads = need(vcf_headers(spark, path), path)
    v = vcf_fixed(raw, "_file").withColumn("dosages", F.transform("cells", lambda c: cell_dosage(c, F.col("format"))))
    if len(heads) > 1:
        names = _vcf_names(heads)
        order = list(dict.fromkeys(n for own in names for n in own))
        at = [{n: i for i, n in enumerate(own)} for own in names]
        places = spark.createDataFrame([(h, [a.get(n) for n in order]) for h, a in enumerate(at)], "_h INT, _places ARRAY<INT>")
        v = numbered(v, heads).join(places, "_h").withColumn("dosages", F.transform("_places", lambda i: F.get("dosages", i)))
    return v.drop("cells", "format", "_file", "_h", "_places")


# ---- matrices and tables ----


def _matrix_headers(spark: SparkSession, path: str) -> tuple[Headers, str, list[list[str]]]:
    """Headers, separator and sample names of feature x sample text."""
    heads = need(file_heads(spark, path, same=label_is), path)
    sep = sniff(heads[0][0])
    return heads, sep, [[n.strip() for n in head.split(sep)][1:] for head, _ in heads]


def wide_matrix(spark: SparkSession, path: str, key: str = "feature_id", numeric: bool = True) -> DataFrame:
    """Feature x sample text to long form; separator from the header; bad cells become null."""
    raw = placed_lines(spark, path)
    heads, sep, names = _matrix_headers(spark, path)
    c = F.split("value", sep)
    body = raw.where(~F.col("value").isin([h for h, _ in heads])).select(c[0].alias(key), "_file", F.slice(c, 2, F.size(c)).alias("cells"))
    cell = to_number(F.trim("cell")) if numeric else na_to_null(F.trim("cell"))
    return named_cells(body, names, heads).select(key, "sample_id", cell.alias("value"))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_TOKENS), c)


def delimited(spark: SparkSession, path: str) -> DataFrame:
    """Table with tab or comma separator; missing tokens become null."""
    df = separated(placed_lines(spark, path), None, path)
    return df.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])


def results(spark: SparkSession, path: str) -> DataFrame:
    """Result table by extension, with canonical column names; p_value and gene_id are required."""
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        df = separated(placed_lines(spark, path), "," if ".csv" in path else "\t", path)
    df = harmonise(df)
    absent = {"p_value", "gene_id"} - set(df.columns)
    if absent:
        raise ValueError(f"result table lacks {sorted(absent)}")
    numeric = [c for c in ("p_value", "beta", "se", "maf", "fdr") if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in numeric})


def nominal_pairs(spark: SparkSession, glob: str) -> DataFrame:
    """Per-chromosome Parquet files; the chromosome comes from the file (or folder) name."""
    df = spark.read.parquet(glob)
    return df.withColumn("chrom", F.regexp_extract("_metadata.file_path", r"cis_qtl_pairs[.=]([^./]+)", 1))


def bed(spark: SparkSession, path: str) -> DataFrame:
    """Annotation intervals; chr, start, end and gene_id are required."""
    df = separated(placed_lines(spark, path).where(~F.startswith("value", F.lit("#"))), "\t", path, notes="#")
    absent = [c for c in ("chr", "start", "end", "gene_id") if c not in df.columns]
    if absent:
        raise ValueError(f"annotation lacks {absent}")
    return df.withColumnsRenamed({"chr": "chrom", "start": "gstart", "end": "gend"}).withColumns(
        {"gstart": F.col("gstart").try_cast("bigint"), "gend": F.col("gend").try_cast("bigint")}
    )


def gtf_genes(raw: DataFrame, gene_types: Sequence[str] = ("protein_coding",), order: str | None = None) -> DataFrame:
    """Gene rows to one-base TSS intervals; the last record of a gene id wins."""
    c = F.split("value", "\t")
    attr = lambda k: F.regexp_extract(c[8], rf'{k} "([^"]*)"', 1)
    rows = raw.where(~F.startswith("value", F.lit("#"))).select(
        c[0].alias("chrom"), c[2].alias("_kind"), c[3].cast("bigint").alias("_s"), c[4].cast("bigint").alias("_e"),
        c[6].alias("strand"), strip_version(attr("gene_id")).alias("gene_id"), attr("gene_type").alias("gene_type"),
        attr("gene_name").alias("gene_name"), *([F.col(order).alias("_line")] if order else [F.struct(c[3].cast("bigint"), "value").alias("_line")]),
    ).where((F.col("_kind") == "gene") & F.col("gene_type").isin(*gene_types))
    rows = first_rows(rows, ["gene_id"], [F.col("_line").desc()])
    tss = F.when(F.col("strand") == "+", F.col("_s")).otherwise(F.col("_e"))
    return rows.select("chrom", tss.alias("gstart"), (tss + 1).alias("gend"), "gene_id", "strand", "gene_name", "gene_type")


def gtf(spark: SparkSession, path: str, gene_types: Sequence[str] = ("protein_coding",)) -> DataFrame:
    raw = lines(spark, path).withColumn("_at", F.struct("_metadata.file_path", "_metadata.file_block_start"))
    return gtf_genes(raw.withColumn("_line", F.struct("_at", F.monotonically_increasing_id())), gene_types, "_line")


def eigenvectors(spark: SparkSession, path: str, k: int = 5) -> DataFrame:
    """PCA scores: FID, IID and up to k PCs that exist, tab or blank separated; each file by its own header."""
    names_of = lambda line: [n.strip().replace("#", "") for n in line.split()]
    heads = need(file_heads(spark, path, same=lambda own, lead: own == lead or not {"FID", "IID"}.isdisjoint(names_of(own))), path)
    raw, c, out = placed_lines(spark, path), F.split(F.trim("value"), r"\s+"), None
    every = [names_of(head) for head, _ in heads]
    wanted = [n for n in ("FID", "IID", *(f"PC{i}" for i in range(1, k + 1))) if any(n in names for names in every)]
    for (head, files), names in zip(heads, every):
        at = {n: c[names.index(n)] if n in names else F.lit(None).cast("string") for n in wanted}
        cells = [(sample_key(v) if n == "IID" else v if n == "FID" else v.try_cast("double")).alias(n) for n, v in at.items()]
        body = raw.where(F.col("value") != head)
        part = (body if len(heads) == 1 else body.where(F.col("_file").isin(files))).select(*cells)
        out = part if out is None else out.unionByName(part)
    return out


def encoded_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """UTF-8 if every line decodes, else Latin-1, which accepts any byte."""
    bad = spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1)
    return spark.read.csv(path, sep=sep, header=True, encoding="UTF-8" if bad.isEmpty() else "ISO-8859-1")


def batch_design(spark: SparkSession, path: str) -> DataFrame:
    """Sample x covariate design in long form, whichever way round the file is."""
    head = header_line(spark, path)
    first = head.split(sniff(head))[0].strip().lower()
    long = wide_matrix(spark, path, "row_id", numeric=False).withColumnRenamed("sample_id", "col_id")
    rows_are_samples = first in ID_HEADERS
    sample, cov = ("row_id", "col_id") if rows_are_samples else ("col_id", "row_id")
    return long.select(F.col(sample).alias("sample_id"), F.col(cov).alias("covariate"), "value")


def _fields(raw: DataFrame, ddl: str) -> DataFrame:
    c = F.split(F.trim("value"), r"\s+")
    parts = [p.split() for p in ddl.split(", ")]
    return raw.select(*[c[i].try_cast(t).alias(n) for i, (n, t) in enumerate(parts)])


def fam(spark: SparkSession, path: str) -> DataFrame:
    return _fields(lines(spark, path), FAM)


def bim(spark: SparkSession, path: str) -> DataFrame:
    return _fields(lines(spark, path), BIM)


def _tolerant(spark: SparkSession, path: str) -> tuple[DataFrame, Headers, str]:
    """Lines but the headers, the headers, and the separator that over half of all lines have.

    The header is the first line whose cells 2-4 are all longer than three characters, else the first line.
    """
    raw, choices = placed_lines(spark, path), ("\t", ",", ";", " ")
    counts = raw.agg(F.count(F.lit(1)), first_of_file(), *[F.count_if(F.contains("value", F.lit(s))) for s in choices]).first()
    sep = next((s for s, n in zip(choices, counts[2:]) if n > counts[0] / 2), "\t")
    c = F.split("value", sep)
    fits = (F.size(c) > 3) & F.forall(F.slice(c, 2, 3), lambda x: F.length(F.trim(x)) > 3)
    heads = file_headers(raw, F.min_by(F.when(fits, F.col("value")), F.when(fits, F.col("_at"))), same_label)
    heads = need(heads or [(h, []) for h in counts[1:2] if h is not None], path)
    return raw.where(~F.col("value").isin([h for h, _ in heads])), heads, sep


def _of_width(heads: Headers, sep: str) -> Column:
    return F.size(F.split("value", sep)).isin(sorted({len(h.split(sep)) for h, _ in heads}))


def tolerant_covariates(spark: SparkSession, path: str) -> DataFrame:
    """Covariate x sample text with any separator and junk before the header; ``ragged_lines`` are left out."""
    body, heads, sep = _tolerant(spark, path)
    c = F.split("value", sep)
    rows = body.where(_of_width(heads, sep)).select(F.trim(c[0]).alias("covariate"), "_file", F.slice(c, 2, F.size(c)).alias("cells"))
    cells = named_cells(rows, [[n.strip() for n in h.split(sep)][1:] for h, _ in heads], heads)
    return cells.select("covariate", "sample_id", na_to_null(F.trim("cell")).alias("value"))


def ragged_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that ``tolerant_covariates`` leaves out for their number of cells: (value)."""
    body, heads, sep = _tolerant(spark, path)
    return body.where(~_of_width(heads, sep)).select("value")


def input_samples(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Sample ids of all files, from the headers alone where the format allows."""
    if kind == "vcf":
        names = vcf_samples(spark, path)
    elif kind == "matrix":
        names = [n for own in _matrix_headers(spark, path)[2] for n in own]
    elif kind == "fam":
        return fam(spark, path).select("sample_id").distinct()
    else:
        return delimited(spark, path).select(F.trim("sample_id").alias("sample_id")).distinct()
    return spark.createDataFrame([(n,) for n in names], "sample_id STRING").distinct()
