"""Readers on folders: a header per file, a header only in the first part, and other orders of samples or columns."""
from allelespark.sources import readers as R


def put(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.txt").write_text(text)
    return str(folder)


def test_vcf_names_follow_each_file(spark, tmp_path):
    fixed = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"
    row = "1\t{}\trs{}\tA\tG\t50\tPASS\tAF=0.1\tGT\t{}\n"
    path = put(
        tmp_path,
        a="##x\n" + fixed + "\tA\tB\n" + row.format(1, 1, "0|0\t1|1"),
        b=row.format(2, 2, "0|1\t1|1"),  # continues a
        c=fixed + "\tB\tA\tC\n" + row.format(3, 3, "0|0\t1|1\t0|1"),
    )
    got = {(r.variant_id, r.sample_id): r.dosage for r in R.vcf_long(spark, path).collect()}
    assert got == {("rs1", "A"): 0, ("rs1", "B"): 2, ("rs2", "A"): 1, ("rs2", "B"): 2, ("rs3", "A"): 2, ("rs3", "B"): 0, ("rs3", "C"): 1}
    assert R.vcf_samples(spark, path) == ["A", "B", "C"]
    arrays = {r.variant_id: r.dosages for r in R.vcf_dosages(spark, path).collect()}
    assert arrays == {"rs1": [0, 2, None], "rs2": [1, 2, None], "rs3": [2, 0, 1]}


def test_matrix_names_follow_each_file(spark, tmp_path):
    path = put(tmp_path, a="gene\tA\tB\nG1\t1\t2\n", b="G2\t3\tx\n", c="gene\tB\tA\nG3\t5\t6\n")
    got = {(r.feature_id, r.sample_id): r.value for r in R.wide_matrix(spark, path).collect()}
    assert got == {("G1", "A"): 1, ("G1", "B"): 2, ("G2", "A"): 3, ("G2", "B"): None, ("G3", "B"): 5, ("G3", "A"): 6}


def test_tables_keep_rows_of_every_part(spark, tmp_path):
    path = put(tmp_path, a="x,y\n1,2\n", b="3,NA\n5,6\n", c="x,y\n7,8\n", d='y,x\n10,"9"\n')
    got = sorted((r.x, r.y) for r in R.delimited(spark, path).collect())
    assert got == [("1", "2"), ("3", None), ("5", "6"), ("7", "8"), ("9", "10")]


def test_bed_in_parts(spark, tmp_path):
    path = put(tmp_path, a="# note\nchr\tstart\tend\tgene_id\nchr1\t1\t2\tG1\n", b="chr2\t3\t4\tG2\n")
    assert sorted((r.chrom, r.gstart, r.gend, r.gene_id) for r in R.bed(spark, path).collect()) == [("chr1", 1, 2, "G1"), ("chr2", 3, 4, "G2")]


def test_header_of_covariates_may_stand_anywhere(spark, tmp_path):
    path = put(tmp_path, a="made,by,a,tool\n" * 30, b="id,SAMP1,SAMP2,SAMP3\nsex,1,NA,2\nbroken,1\n")
    got = {(r.covariate, r.sample_id): r.value for r in R.tolerant_covariates(spark, path).where("covariate = 'sex'").collect()}
    assert got == {("sex", "SAMP1"): "1", ("sex", "SAMP2"): None, ("sex", "SAMP3"): "2"}
    assert [r.value for r in R.ragged_lines(spark, path).collect()] == ["broken,1"]


def test_eigenvectors_follow_each_file(spark, tmp_path):
    path = put(tmp_path, a="#FID IID PC1 PC2\nf1 s1 0.1 0.2\n", b="f2 s2 0.3 0.4\n", c="#IID\tPC2\tPC1\ns3\t0.6\t0.5\n")
    got = sorted(tuple(r) for r in R.eigenvectors(spark, path).select("IID", "FID", "PC1", "PC2").collect())
    assert got == [("s1", "f1", 0.1, 0.2), ("s2", "f2", 0.3, 0.4), ("s3", None, 0.5, 0.6)]


def test_headers_take_first_lines_only(spark, tmp_path):
    """Also of compressed files; no job runs for them."""
    import gzip

    with gzip.open(tmp_path / "a.vcf.gz", "wt") as f:
        f.write("##x\n" * 50 + "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\n" + "1\t1\trs1\tA\tG\t50\tPASS\t.\tGT\t0|0\t0|1\n" * 1000)
    (tmp_path / "b.vcf").write_text("1\t2\trs2\tA\tG\t50\tPASS\t.\tGT\t0|0\t0|1\n#CHROM\tno header\n")
    (tmp_path / "c.vcf").write_text("")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    heads = R.vcf_headers(spark, str(tmp_path))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert [(h.split("\t")[9:], len(files)) for h, files in heads] == [(["A", "B"], 3)]
    assert R.vcf_samples(spark, str(tmp_path)) == ["A", "B"]
