"""Queries of readers, writers and what only text tells: files are made from the mapped tables, read by the engine's own
readers, and compared with the tables by SQL."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helicase.functions import genotype, text
from helicase.operators import annotate, association, burden, genetests, identifiers, inheritance, report, scoring, statistics
from helicase.plans import adapter as a
from helicase.plans import config
from helicase.plans.catalogue import ORACLE_SQL, PRIORITISED, QUERIES, coast_classify, fam, missing_calls, nation_regions, query, r6
from helicase.plans.analysis import filter_schema
from helicase.plans.filterlang import compile_filter
from helicase.sources import blockvcf, sheets, sinks, tables, typed, vcf
from helicase.sources.store import located, put_text, shared_dir, text_of
from helicase.streaming import gene_counts, vcf_folder

__all__ = ["ORACLE_SQL", "QUERIES"]


def written(spark: SparkSession, name: str, lines: DataFrame, head: list[str] = (), suffix: str = "txt") -> str:
    """A file's path: the head and then the lines (column value), in one file."""
    folder = shared_dir(spark, name)
    rows = spark.createDataFrame([(h,) for h in head], "value string").coalesce(1).union(lines) if head else lines
    rows.coalesce(1).write.text(folder)
    root, store = located(spark, folder)
    part = next(s.getPath() for s in store.listStatus(root) if s.getPath().getName().startswith("part-"))
    target, _ = located(spark, f"{folder}/{name}.{suffix}")
    store.rename(part, target)
    return f"{folder}/{name}.{suffix}"


def tabbed(*columns: Column | str, sep: str = "\t") -> Column:
    cells = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.concat_ws(sep, *cells).alias("value")


# VCF

HEAD = [
    "##fileformat=VCFv4.2", '##INFO=<ID=AF,Number=A,Type=Float,Description="Allele frequency">', '##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele count">',
    '##INFO=<ID=ANN,Number=.,Type=String,Description="Functional annotation">', '##INFO=<ID=NMD,Number=.,Type=String,Description="Decay">', '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Read depth">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tkid\tdad\tmum",
]
GTS = ["0/0", "0/1", "1/1", "./."]


def vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("variant_id")
    gt = lambda by: F.concat(F.get(F.lit(GTS), ((k / by).cast("bigint") % 4).cast("int")), F.lit(":"), (k % 60).cast("string"))
    ann = F.concat_ws("|", "alt", "effect", "impact", "gene", F.lit("ENSG1"), F.lit("t"), F.concat(F.lit("NM_"), (k % 5).cast("string"), F.lit(".1")), F.lit(""), F.lit(""), F.lit("c.1"), F.concat(F.lit("p.Arg"), F.col("p_size").cast("string"), F.lit("Trp")), F.lit(""), F.lit(""), F.concat(F.col("p_size").cast("string"), F.lit("/500")), F.lit(""))
    info = F.concat(F.lit("AF="), F.format_string("%.5f", "af"), F.when(F.col("ac").isNotNull(), F.concat(F.lit(";AC="), "ac")).otherwise(""), F.lit(";ANN="), F.translate(ann, " ", "_"), F.lit(",X|other|LOW|G"), F.when(k % 4 == 0, ";NMD=G1|x|1|0.9").otherwise(""))
    filt = F.coalesce("filter", F.lit("."))
    return a.variants(spark, sf_dir).select(tabbed("chrom", "pos", k, "ref", "alt", "p_size", filt, info, F.lit("GT:DP"), gt(1), gt(4), gt(16)))


def vcf_file(spark: SparkSession, sf_dir: str) -> str:
    return written(spark, "made", vcf_lines(spark, sf_dir), HEAD, "vcf")


IN_REGIONS = ", regions AS (SELECT (n_nationkey % 23)::VARCHAR AS chrom, n_nationkey * 3000 AS start, n_nationkey * 3000 + 40000 AS \"end\" FROM nation) SELECT variant_id, chrom, pos FROM variants v WHERE EXISTS (SELECT 1 FROM regions r WHERE r.chrom = v.chrom AND v.pos > r.start AND v.pos - 1 < r.\"end\")"


@query(IN_REGIONS + " AND af < 0.03 AND p_size >= 5")
def vcf_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions from a file and a prefilter in one scan."""
    bed = written(spark, "regions", nation_regions(spark, sf_dir).select(tabbed(F.concat(F.lit("chr"), "chrom"), "start", "end", "name")), ["#made", "track x"], "bed")
    rows = vcf.read_vcf(spark, vcf_file(spark, sf_dir), tables.read_bed(spark, bed), "INFO/AF < 0.03 && QUAL >= 5")
    return rows.select(F.col("id").cast("bigint").alias("variant_id"), "chrom", "pos")


@query(IN_REGIONS)
def vcf_sorted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same regions from records that lie in order as Parquet."""
    path = shared_dir(spark, "sorted")
    vcf.write_sorted(vcf.read_vcf(spark, vcf_file(spark, sf_dir)), path)
    return vcf.scan_regions(spark, path, nation_regions(spark, sf_dir)).select(F.col("id").cast("bigint").alias("variant_id"), "chrom", "pos")


@query(IN_REGIONS)
def vcf_index_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same regions from block-gzip files with an index, of which only the regions' blocks are opened."""
    path = shared_dir(spark, "blocks")
    blockvcf.write_indexed(vcf_lines(spark, sf_dir), HEAD, path)
    regions = nation_regions(spark, sf_dir)
    records = vcf.overlapping(vcf.parsed(blockvcf.records_of(spark, path, regions).select("value")), regions)
    return records.select(F.col("id").cast("bigint").alias("variant_id"), "chrom", "pos")


TYPED_RARE = "((AF[0] < 0.01) | (na AC[0])) & (FILTER = 'PASS' | QUAL >= 20)"


@query("""SELECT variant_id, round(af, 5)::DOUBLE AS af, TRY_CAST(ac AS BIGINT) AS ac FROM variants
 WHERE (printf('%.5f', af)::DOUBLE < 0.01 OR ac IS NULL OR ac IN ('.', '', 'NA')) AND (coalesce(filter = 'PASS', false) OR p_size >= 20)""")
def typed_rare_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rare records from a store of typed fields, whose statistics answer the filter."""
    path = shared_dir(spark, "typed")
    head = spark.range(1).select(F.explode(F.lit(HEAD)).alias("value"))  # rows that no Python worker makes
    header = vcf.header_fields(head)
    typed.write_store(vcf.parsed(vcf_lines(spark, sf_dir)), header, HEAD, path)
    schema = typed.stored_schema(filter_schema(header), header)
    rows = typed.read_store(spark, path).where(compile_filter(TYPED_RARE, schema))
    return rows.select(F.col("id").cast("bigint").alias("variant_id"), F.col("number_AF").alias("af"), F.get("list_AC", F.lit(0)).alias("ac"))


@query("""SELECT variant_id::VARCHAR AS "ID", coalesce(filter, 'NA') AS "FILTER", printf('%.5f', af) AS "AF", coalesce(ac, 'NA') AS "AC", effect AS "ANN_0__EFFECT", replace(gene, ' ', '_') AS "ANN_0__GENE", 'p.Arg' || p_size || 'Trp' AS "ANN_0__HGVS_P", p_size::VARCHAR AS "ANN_0__AA_POS",
 CASE WHEN variant_id % 4 = 0 THEN 'G1' ELSE 'NA' END AS "NMD_0__GENE", ['0/0', '0/1', '1/1', './.'][(variant_id % 4 + 1)::INT] AS "GEN_0__GT", (variant_id % 60)::VARCHAR AS "GEN_1__DP", 'NA' AS "ABSENT" FROM variants""")
def vcf_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["ID", "FILTER", "AF", "AC", "ANN[0].EFFECT", "ANN[0].GENE", "ANN[0].HGVS_P", "ANN[0].AA_POS", "NMD[0].GENE", "GEN[0].GT", "GEN[1].DP", "ABSENT"]
    path = vcf_file(spark, sf_dir)
    return vcf.fields(vcf.read_vcf(spark, path), wanted, vcf.sample_names(vcf.lines(spark, path)))


@query("""SELECT chrom || ':' || pos || ':' || ref || '>' || alt AS variant_key, sample_id, ['0/0', '0/1', '1/1', './.'][i + 1] AS gt, CASE i WHEN 1 THEN 1 WHEN 2 THEN 2 END AS dosage
 FROM (SELECT *, unnest(['kid', 'dad', 'mum']) AS sample_id, unnest([variant_id % 4, (variant_id // 4) % 4, (variant_id // 16) % 4])::INT AS i FROM variants) WHERE i > 0""")
def vcf_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vcf_file(spark, sf_dir)
    return vcf.calls(vcf.read_vcf(spark, path), vcf.sample_names(vcf.lines(spark, path))).select("variant_key", "sample_id", "gt", "dosage")


@query("""SELECT * FROM (VALUES ('INFO', 'AC', 'A', 'Integer', 'Allele count'), ('INFO', 'AF', 'A', 'Float', 'Allele frequency')) t(source, id, number, type, description)""", base=False)
def vcf_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vcf.matching_fields(vcf.header_fields(vcf.lines(spark, vcf_file(spark, sf_dir))), "allele", "INFO")


@query("SELECT count(*)::BIGINT AS records, 'kid,dad,mum' AS samples, 'NOPE,GEN[0].XX' AS absent, min(pos) AS first FROM variants")
def vcf_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vcf_file(spark, sf_dir)
    raw = vcf.lines(spark, path)
    absent = vcf.missing_fields(vcf.header_fields(raw), ["POS", "AF", "GEN[0].DP", "NOPE", "GEN[0].XX"])
    first = vcf.chromosome_spans(vcf.parsed(raw)).agg(F.min("start").alias("first"))
    return first.select(F.lit(vcf.count_records(spark, path)).cast("bigint").alias("records"), F.lit(",".join(vcf.sample_names(raw))).alias("samples"), F.lit(",".join(sorted(absent, reverse=True))).alias("absent"), "first")


@query("SELECT variant_id, unnest(['AF=' || printf('%.5f', af), 'n']) AS part, 2 AS entries FROM variants WHERE FALSE UNION ALL SELECT variant_id, 'ANN', 2 FROM variants")
def vcf_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One effect a record, written as lines and read again."""
    one = vcf.one_effect_per_row(vcf.read_vcf(spark, vcf_file(spark, sf_dir)))
    again = vcf.parsed(vcf.write_vcf_lines(one))
    n = again.where(F.size(F.split(F.element_at("info", F.lit("ANN")), ",")) == 1).groupBy("id").agg(F.count("*").cast("int").alias("entries"))
    return n.select(F.col("id").cast("bigint").alias("variant_id"), F.lit("ANN").alias("part"), "entries")


@query("""SELECT p_partkey::VARCHAR AS "A", CASE WHEN p_size % 3 = 0 THEN 'NA' ELSE p_brand END AS "B", CASE WHEN p_size % 4 = 0 THEN 'x' ELSE 'NA' END AS "EXTRA_0" FROM part""", base=False)
def irregular_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with fewer and more cells than there are columns."""
    brand = F.when(F.col("p_size") % 3 == 0, ".").otherwise(F.col("p_brand"))
    line = F.concat(F.col("p_partkey").cast("string"), F.when((F.col("p_size") % 3 == 0) & (F.col("p_size") % 4 != 0) & (F.col("p_size") % 2 == 0), F.lit("")).otherwise(F.concat(F.lit("\t"), brand)), F.when(F.col("p_size") % 4 == 0, "\tx").otherwise(""))
    return vcf.regular(spark.read.text(written(spark, "rows", a.table(spark, sf_dir, "part").select(line.alias("value")))), ["A", "B"])


@query("SELECT variant_id, chrom FROM variants WHERE p_size > 10")
def vcf_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive in a folder, filtered as a stream and appended to a table."""
    base = shared_dir(spark, "stream")
    vcf_lines(spark, sf_dir).repartition(3).write.text(f"{base}/in")
    vcf_folder.to_parquet(vcf_folder.records(spark, f"{base}/in", "QUAL > 10"), f"{base}/out", f"{base}/at").awaitTermination()
    return spark.read.parquet(f"{base}/out").select(F.col("id").cast("bigint").alias("variant_id"), F.col("chrom").cast("string").alias("chrom"))


@query("SELECT chrom, count(*)::BIGINT AS n FROM variants GROUP BY chrom")
def vcf_stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in batches, each of which leaves its counts under its own number."""
    base = shared_dir(spark, "batches")
    vcf_lines(spark, sf_dir).repartition(3).write.text(f"{base}/in")

    def step(rows: DataFrame, batch: int) -> None:
        rows.groupBy("chrom").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{base}/out/batch={batch}")

    vcf_folder.in_batches(vcf_folder.records(spark, f"{base}/in"), step, f"{base}/at").awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("chrom").agg(F.sum("n").alias("n"))


def placed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """calls with a place on one chromosome where genes lie one after the other."""
    calls = a.calls(spark, sf_dir)
    genes = calls.select("gene").distinct().withColumn("g", F.dense_rank().over(Window.orderBy("gene")))
    return calls.join(genes, "gene").select("gene", "variant_id", "sample_id", "dosage", (F.col("g") * 1000 + F.col("variant_id") % 1000).alias("pos"))


@query(", best AS (SELECT gene, sample_id, max(dosage) AS d FROM calls GROUP BY gene, sample_id), n AS (SELECT gene, count(DISTINCT variant_id)::BIGINT AS n_variants FROM calls GROUP BY gene) SELECT b.gene, count(*) FILTER (WHERE is_case)::BIGINT AS case_carriers, count(*) FILTER (WHERE NOT is_case)::BIGINT AS control_carriers, coalesce(sum(d) FILTER (WHERE is_case), 0)::BIGINT AS case_alleles, coalesce(sum(d) FILTER (WHERE NOT is_case), 0)::BIGINT AS control_alleles, n_variants FROM best b JOIN samples s ON s.sample_id = b.sample_id JOIN n ON n.gene = b.gene GROUP BY b.gene, n_variants")
def stream_gene_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Burden counts from files of calls that arrive in the order of their places, genes across files; a second start of the
    query finds the state of the first, and two calls at the end of the chromosome close what is open."""
    base, late = shared_dir(spark, "gene-stream"), 1 << 20
    rows, who = placed_calls(spark, sf_dir), a.cohort(spark, sf_dir)
    rows.repartitionByRange(4, "pos").sortWithinPartitions("pos").write.parquet(f"{base}/in")

    def run() -> None:
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        counts = gene_counts.gene_counts(stream.withColumn("at", gene_counts.at_place(F.lit(0), F.col("pos"))), who, late)
        writer = counts.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/at").outputMode("append")
        writer.trigger(availableNow=True).start().awaitTermination()

    run()
    end = rows.orderBy("pos").limit(1).select(F.lit("").alias("gene"), "variant_id", "sample_id", "dosage", F.lit(400_000_000).cast("bigint").alias("pos"))
    for _ in range(2):  # the first moves the watermark, with the second genes are told
        end.coalesce(1).write.mode("append").parquet(f"{base}/in")
    run()
    return spark.read.schema(gene_counts.COUNTS).parquet(f"{base}/out")


# side tables


@query("SELECT family_id, sample_id, father_id, mother_id, sex, CASE WHEN affected THEN '2' ELSE '1' END AS affected_status FROM pedigree")
def pedigree_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = a.pedigree(spark, sf_dir)
    parent = lambda c: F.when(F.col(c) == "0", ".").otherwise(F.col(c))
    return tables.read_ped(spark, written(spark, "fam", p.select(tabbed("family_id", "sample_id", parent("father_id"), parent("mother_id"), "sex", F.when(F.col("affected"), "2").otherwise("1"))), ["#family"], "ped"))


PHENOTYPES = ", terms AS (SELECT sample_id, unnest(CASE s_nationkey % 3 WHEN 0 THEN ['HP:1'] WHEN 1 THEN ['HP:2', 'HP:1', 'HP:2'] ELSE ['HP:3'] END) AS term FROM samples)"


def phenotype_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_nationkey") % 3
    terms = F.when(k == 0, F.array(F.lit("HP:1"))).when(k == 1, F.array(F.lit("HP:2"), F.lit("HP:1"), F.lit("HP:2"))).otherwise(F.array(F.lit("HP:3")))
    rows = a.samples(spark, sf_dir).select("sample_id", F.explode(terms).alias("t"))
    return tables.read_phenotypes(spark, written(spark, "terms", rows.select(tabbed("t", "sample_id", sep=",")), ["Term,Who"], "csv"), "Who", "Term")


@query(PHENOTYPES + " SELECT sample_id, string_agg(DISTINCT term, ',' ORDER BY term) AS terms FROM terms GROUP BY sample_id")
def phenotype_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phenotype_file(spark, sf_dir).select("sample_id", F.array_join("terms", ",").alias("terms"))


@query("SELECT sample_id, s_nationkey % 3 = 1 AS is_case FROM samples WHERE s_nationkey % 3 <> 0")
def cohort_from_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms from files of their own decide who is a case."""
    cases, controls = (written(spark, "t", spark.createDataFrame([(t,)], "value string"), ["# terms"]) for t in ("HP:2", "HP:3"))
    named = [[r.value for r in tables.read_lines(spark, p).collect()] for p in (cases, controls)]
    rows = a.samples(spark, sf_dir).select("sample_id").join(phenotype_file(spark, sf_dir), "sample_id", "left")
    return burden.cohort_by_terms(rows, *named)


@query("SELECT sample_id, s_nationkey % 4 = 0 AS is_case FROM samples WHERE s_nationkey % 4 < 2")
def cohort_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = a.samples(spark, sf_dir)
    read = lambda k: tables.read_lines(spark, written(spark, "ids", s.where(F.col("s_nationkey") % 4 == k).select(F.col("sample_id").alias("value")))).withColumnRenamed("value", "sample_id")
    return burden.cohort(s, read(0), read(1))


@query("SELECT sample_id, 'T' || (s_nationkey % 2) AS terms FROM samples")
def shortened_sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phenotypes under names without what file names add."""
    s = a.samples(spark, sf_dir)
    longer = s.select(F.when(F.col("place") % 2 == 0, F.concat("sample_id", F.lit("_L1"))).otherwise(F.col("sample_id")).alias("sample_id"))
    terms = s.select("sample_id", F.array(F.concat(F.lit("T"), (F.col("s_nationkey") % 2).cast("string"))).alias("terms"))
    return burden.by_shortened_ids(longer, terms, "_L1").select(F.replace("sample_id", F.lit("_L1"), F.lit("")).alias("sample_id"), F.array_join("terms", ",").alias("terms"))


@query("SELECT sample_id, s_acctbal::DOUBLE AS age, (s_nationkey % 3 = 1)::INT::DOUBLE AS site_B, (s_nationkey % 3 = 2)::INT::DOUBLE AS site_C, (s_suppkey % 7)::DOUBLE AS pc1, (s_suppkey % 11)::DOUBLE / 2 AS pc2 FROM samples")
def covariates_and_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covariates with a coded text column beside components, for the samples of the cohort."""
    s = a.samples(spark, sf_dir)
    site = F.get(F.lit(["A", "B", "C"]), (F.col("s_nationkey") % 3).cast("int"))
    cov = written(spark, "cov", s.select(tabbed("sample_id", "s_acctbal", site)), ["id\tage\tsite"], "tsv")
    vec = written(spark, "pca", s.select(tabbed("sample_id", "sample_id", F.col("s_suppkey") % 7, (F.col("s_suppkey") % 11) / 2, sep=" ")), ["#FID IID PC1 PC2"], "eigenvec")
    ids = [r.sample_id for r in s.select("sample_id").collect()]
    return tables.read_covariates(spark, cov, ids).join(tables.read_components(spark, vec, 2), "sample_id")


@query("SELECT DISTINCT upper(p_brand) AS gene, CASE WHEN p_size % 2 = 0 THEN 'even_list' ELSE 'odd_list' END AS list_name FROM part", base=False)
def gene_list_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = a.table(spark, sf_dir, "part")
    found = []
    for name, k in (("even list", 0), ("odd list", 1)):
        genes = sorted({r.p_brand for r in part.where(F.col("p_size") % 2 == k).select("p_brand").distinct().collect()})
        path = put_text(spark, f"{shared_dir(spark, 'lists')}/{name}.txt", "# genes\n" + ",".join(genes[:3]) + "\n" + "\n".join(genes[3:]) + "\n\n")
        found.append(tables.read_gene_list(spark, path).withColumn("list_name", F.lit(text.list_name(path))))
    return found[0].unionByName(found[1]).select("gene", "list_name")


@query("SELECT p_brand AS gene, max(p_size)::VARCHAR AS size, max(p_type) AS kind FROM part GROUP BY p_brand", base=False)
def gene_json_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gene attributes from a list of objects and from an object of objects."""
    rows = a.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("symbol")).agg(F.max("p_size").cast("string").alias("size"), F.max("p_type").alias("kind"), F.lit("x").alias("other")).collect()
    half = len(rows) // 2
    base = shared_dir(spark, "json")
    listed = put_text(spark, f"{base}/a.json", json.dumps([r.asDict() for r in rows[:half]]))
    keyed = put_text(spark, f"{base}/b.json", json.dumps({r.symbol: r.asDict() for r in rows[half:]}))
    parts = [tables.read_gene_json(spark, p, "symbol", ["size", "kind"]) for p in (listed, keyed)]
    both = parts[0].unionByName(parts[1])
    back = a.table(spark, sf_dir, "part").select("p_brand").distinct()
    return both.join(back, F.upper("p_brand") == F.col("gene")).select(F.col("p_brand").alias("gene"), F.element_at("attributes", F.lit("size")).alias("size"), F.element_at("attributes", F.lit("kind")).alias("kind"))


CLINVAR = "SELECT DISTINCT p_brand AS gene, p_size::INT AS aa_pos, 'R' AS ref_aa, substr('CGHLQSWP', (p_size % 8 + 1)::INT, 1) AS alt_aa, CASE p_partkey % 3 WHEN 0 THEN 'P' ELSE 'LP' END AS clnsig FROM part WHERE p_partkey % 3 < 2"


def clinvar_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    alt = F.get(F.lit(["Cys", "Gly", "His", "Leu", "Gln", "Ser", "Trp", "Pro"]), (F.col("p_size") % 8).cast("int"))
    name = F.concat(F.lit("NM_1("), "p_brand", F.lit("):c.1A>G (p.Arg"), F.col("p_size").cast("string"), alt, F.lit(")"))
    sig = F.get(F.lit(["Pathogenic", "Likely pathogenic", "Benign"]), k.cast("int"))
    rows = a.table(spark, sf_dir, "part").select(tabbed(F.lit("1"), F.lit("single nucleotide variant"), name, "p_brand", sig, F.lit("germline"), F.lit("GRCh38"), F.lit("reviewed by expert panel")))
    return tables.read_clinvar_summary(spark, written(spark, "summary", rows, ["#AlleleID\tType\tName\tGeneSymbol\tClinicalSignificance\tOrigin\tAssembly\tReviewStatus"], "tsv"))


@query(CLINVAR, base=False)
def clinvar_lookup_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A significance summary becomes a lookup, which is written and read again."""
    path = shared_dir(spark, "lookup")
    sinks.write_pm5_lookup(annotate.pm5_lookup(clinvar_file(spark, sf_dir)), path)
    return tables.read_pm5_lookup(spark, path).drop("review")


@query("SELECT p_partkey::VARCHAR AS gene, (1.0 + p_size % 5)::DOUBLE AS weight FROM part", base=False)
def gene_weights_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.table(spark, sf_dir, "part").select(tabbed("p_partkey", (F.lit(1.0) + F.col("p_size") % 5)))
    return tables.read_gene_weights(spark, written(spark, "weights", rows, ["gene\tweight"], "tsv"))


@query("SELECT n_name AS sample, n_nationkey::VARCHAR AS file FROM nation", base=False)
def manifest_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.read_manifest(spark, written(spark, "manifest", a.table(spark, sf_dir, "nation").select(tabbed("n_name", "n_nationkey")), ["sample\tfile"], "tsv"))
    return spark.createDataFrame([(k, v["file"]) for k, v in found.items()], "sample string, file string")


@query("""SELECT v.variant_id, c.sample_id, 'r/' || c.sample_id AS reads, v.chrom || ':' || greatest(pos - 50, 1) || '-' || (pos + length(ref) - 1 + 50) AS region, c.sample_id || '_' || v.chrom || '_' || pos || '_' || ref || '_' || alt || '_report.html' AS path
 FROM calls c JOIN variants v ON v.variant_id = c.variant_id JOIN samples s ON s.sample_id = c.sample_id WHERE s.s_suppkey % 3 = 0""")
def report_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a browser report is drawn for: carriers whose reads a file names."""
    s = a.samples(spark, sf_dir)
    named = F.when(F.col("s_suppkey") % 3 == 0, F.col("sample_id")).otherwise(F.concat(F.lit("other_"), "sample_id"))
    reads = tables.read_reads(spark, written(spark, "reads", s.select(tabbed(named, F.concat(F.lit("r/"), "sample_id"), sep=",")), ["# sample,reads"], "csv"))
    return annotate.report_jobs(a.variants(spark, sf_dir), a.calls(spark, sf_dir), reads).select("variant_id", "sample_id", "reads", "region", "path")


@query("SELECT v.variant_id, coalesce(string_agg(c.sample_id || ':x/' || c.sample_id, ';' ORDER BY c.sample_id), '') AS links FROM variants v LEFT JOIN calls c ON c.variant_id = v.variant_id AND c.dosage = 2 GROUP BY v.variant_id")
def report_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    hom = a.calls(spark, sf_dir).where("dosage = 2").join(a.variants(spark, sf_dir).select("variant_id", "chrom", "pos", "ref", "alt"), "variant_id")
    return annotate.with_reports(a.variants(spark, sf_dir), hom.withColumn("path", F.concat(F.lit("x/"), "sample_id"))).select("variant_id", "links")


@query("SELECT n_name AS sample_id, l_linenumber::VARCHAR AS \"N\", count(*)::BIGINT AS n FROM nation, (SELECT DISTINCT l_linenumber FROM lineitem) GROUP BY ALL", base=False)
def cohort_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table a sample, all read together; the sample comes from the file's name."""
    # N and n are two columns: what is made of the result, a file too, needs a session that tells them apart
    spark = spark.newSession()
    spark.conf.set("spark.sql.caseSensitive", "true")
    base = shared_dir(spark, "cohort")
    numbers = [r[0] for r in a.table(spark, sf_dir, "lineitem").select("l_linenumber").distinct().orderBy("l_linenumber").collect()]
    for r in a.table(spark, sf_dir, "nation").select("n_name").collect():
        put_text(spark, f"{base}/{r.n_name.replace(' ', '+')}.variants.tsv", "N\tM\n" + "".join(f"{i}\tx\n" for i in numbers))
    rows = tables.read_sample_files(spark, f"{base}/*.variants.tsv", r"([^/]+)\.variants\.tsv$")
    return rows.groupBy(F.replace(F.replace("sample_id", F.lit("%2B"), F.lit("+")), F.lit("+"), F.lit(" ")).alias("sample_id"), "N").agg(F.count("*").alias("n"))


@query("""SELECT chrom, min(start) AS start, max("end") AS "end" FROM (SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
  SELECT *, CASE WHEN start > max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM (
   SELECT 'chr' || (p_partkey % 23) AS chrom, greatest(p_partkey * 10 - 200, 0) AS start, p_partkey * 10 + 100 + p_size * 5 + 200 AS "end" FROM part WHERE p_brand <> 'Brand#11'))) GROUP BY chrom, island""", base=False)
def gene_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes of a list found in a table of coordinates: widened, merged, with another spelling of chromosomes."""
    rows = a.table(spark, sf_dir, "part").select(tabbed(F.concat(F.lit("chr"), (F.col("p_partkey") % 23).cast("string")), F.col("p_partkey") * 10, F.col("p_partkey") * 10 + 100 + F.col("p_size") * 5, F.replace("p_brand", F.lit(" "), F.lit("_"))))
    coordinates = tables.read_gene_coordinates(spark, written(spark, "genes", rows, suffix="bed"))
    names = [r.p_brand for r in a.table(spark, sf_dir, "part").where("p_brand <> 'Brand#11'").select("p_brand").distinct().collect()]
    genes = tables.normalised_genes(", ".join(n.replace(" ", "_") for n in names))
    return tables.gene_regions(coordinates, genes, 200, "chr")


@query("SELECT p_brand AS \"B\", p_partkey::VARCHAR AS \"A_B\", p_type AS \"col_1x\" FROM part", base=False)
def variant_table_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of any name become identifiers."""
    path = written(spark, "t", a.table(spark, sf_dir, "part").select(tabbed("p_brand", "p_partkey", "p_type")), ["B\tA.B\t1x"], "tsv")
    return tables.read_variants_tsv(spark, path)[0]


@query("SELECT sample_id, (s_acctbal / 10 + CASE WHEN s_nationkey % 2 = 0 THEN 2 ELSE 0 END)::DOUBLE AS s FROM samples")
def scoring_model_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    import tempfile

    with tempfile.TemporaryDirectory() as folder:
        for name, value in (("variable_assignment_config", {"variables": {"BAL": "bal|default:0", "KIND": "kind|default:''"}}), ("formula_config", {"output_scores": ["s"], "formulas": [{"s": "bal / 10 + (kind == 'even') * 2"}]})):
            with open(f"{folder}/{name}.json", "w", encoding="utf-8") as f:
                json.dump(value, f)
        model = tables.read_scoring_model(folder)
    rows = a.samples(spark, sf_dir).select("sample_id", F.col("s_acctbal").cast("string").alias("BAL"), F.when(F.col("s_nationkey") % 2 == 0, "even").otherwise("odd").alias("KIND"))
    return scoring.apply_scoring(rows, model).select("sample_id", F.col("s").cast("double").alias("s"))


# sinks


@query("SELECT variant_id::VARCHAR AS \"ID\", coalesce(filter, 'NA') AS \"ANN[0].X\", p_type AS kind FROM variants")
def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as one file under its old names, without internal columns, and as a folder of parts."""
    v = a.variants(spark, sf_dir).select(F.col("variant_id").alias("ID"), F.col("filter").alias("ANN_0__X"), F.col("p_type").alias("kind"), F.lit("x").alias("_hidden"))
    base = shared_dir(spark, "out")
    sinks.write_one_tsv(v.where("ID % 2 = 0"), f"{base}/one.tsv.gz", {"ANN[0].X": "ANN_0__X"})
    sinks.write_tsv(v.where("ID % 2 = 1"), f"{base}/parts", {"ANN[0].X": "ANN_0__X"}, "gzip")
    return tables.read_delimited(spark, f"{base}/one.tsv.gz").unionByName(tables.read_delimited(spark, f"{base}/parts"))


@query("SELECT gene AS \"GENE\", count(*)::VARCHAR AS n, 'https://x/' || replace(gene, ' ', '_') AS link FROM variants GROUP BY gene")
def workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A workbook's sheet, read back from its cells."""
    rows = a.table_of(a.variants(spark, sf_dir)).groupBy("GENE").agg(F.count("*").alias("n")).withColumn("link", F.concat(F.lit("https://x/"), F.replace("GENE", F.lit(" "), F.lit("_"))))
    path = sheets.write_workbook(spark, {"Genes & more": rows, "Metadata": spark.createDataFrame([("a", "b")], "Parameter string, Value string")}, f"{shared_dir(spark, 'book')}/a.xlsx")
    import os
    import tempfile

    with tempfile.TemporaryDirectory() as folder:
        found, store = located(spark, path)
        store.copyToLocalFile(False, found, spark._jvm.org.apache.hadoop.fs.Path(f"file://{folder}/a.xlsx"), True)
        cells = sheets.read_workbook(os.path.join(folder, "a.xlsx"))["Genes & more"]
    return spark.createDataFrame([tuple(r) for r in cells[1:]], "GENE string, n string, link string")


@query("SELECT count(*)::BIGINT AS variants, count(DISTINCT gene)::BIGINT AS genes, (SELECT count(DISTINCT sample_id) FROM calls)::BIGINT AS samples, count(*) FILTER (WHERE impact = 'HIGH')::BIGINT AS high, count(*)::BIGINT AS lines FROM variants")
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's JSON and page: the summary is read back from both."""
    v = a.table_of(a.variants(spark, sf_dir))
    summary = report.summary(v, a.calls(spark, sf_dir))
    base = shared_dir(spark, "report")
    sinks.write_report_json(v, summary, base)
    told = json.loads(text_of(spark, f"{base}/summary.json"))
    sheets.write_page(spark, v.select("GENE"), told, f"{base}/index.html")
    page = text_of(spark, f"{base}/index.html")
    again = json.loads(page.split("const data=")[1].split(",hidden=new Set")[0])["summary"]
    row = (again["n_variants"], again["n_genes"], told["n_samples"], again["impacts"]["HIGH"], spark.read.json(f"{base}/variants").count())
    return spark.createDataFrame([row], "variants bigint, genes bigint, samples bigint, high bigint, lines bigint")


@query("SELECT sample_id AS original_id, 'CASE_' || lpad((row_number() OVER (ORDER BY sample_id))::VARCHAR, greatest(3, length((row_number() OVER (ORDER BY sample_id))::VARCHAR))::INT, '0') AS pseudonym_id FROM samples")
def pseudonym_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark, 'names')}/names.tsv"
    sinks.write_pseudonyms(identifiers.sequential(a.samples(spark, sf_dir), "CASE"), path, "sequential")
    return tables.read_delimited(spark, path)


@query("SELECT * FROM (VALUES ('Parameter', 'Value'), ('filter', 'a b c'), ('n', '3')) t(k, v)", base=False)
def metadata_and_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters with their white space made plain, found again in the run's archive."""
    import tarfile
    import tempfile

    base = f"{shared_dir(spark, 'run')}/out"
    sinks.write_metadata(spark, base, {"filter": "a\tb \n c", "n": 3})
    path = sinks.write_archive(spark, base, f"{base}.tar.gz")
    with tempfile.TemporaryDirectory() as folder:
        found, store = located(spark, path)
        store.copyToLocalFile(False, found, spark._jvm.org.apache.hadoop.fs.Path(f"file://{folder}/a.tar.gz"), True)
        with tarfile.open(f"{folder}/a.tar.gz") as tar:
            lines = tar.extractfile("out/metadata.tsv").read().decode().splitlines()
    return spark.createDataFrame([tuple(x.split("\t")) for x in lines], "k string, v string")


# annotation and names


@query("SELECT variant_id, CASE WHEN p_size < 20 THEN 'yes' ELSE 'no' END AS small_ones, CASE WHEN p_size % 2 = 0 THEN 'yes' ELSE 'no' END AS list_2nd FROM variants")
def gene_list_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = a.variants(spark, sf_dir).select("variant_id", F.concat(F.lit("g"), F.col("p_size").cast("string")).alias("gene"))
    sizes = a.table(spark, sf_dir, "part").select("p_size").distinct()
    gene = lambda hit, g: F.when(hit, F.concat(F.lit(g), F.col("p_size").cast("string"))).otherwise("none")
    lists = sizes.select(F.lit("small ones.txt").alias("list_name"), gene(F.col("p_size") < 20, "G").alias("gene"))
    lists = lists.union(sizes.select(F.lit("2nd.genes.txt"), gene(F.col("p_size") % 2 == 0, "g")))
    return annotate.gene_list_flags(v, lists, ["small ones.txt", "2nd.genes.txt"]).drop("gene")


@query(", labels AS (SELECT variant_id, unnest(CASE WHEN p_size % 2 = 0 THEN ['Region=a', 'InGeneList=b'] WHEN p_size % 3 = 0 THEN ['Region=c'] ELSE [] END) AS l FROM variants) SELECT split_part(l, '=', 1) AS kind, count(*)::BIGINT AS n FROM labels GROUP BY ALL")
def annotation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_of_row = F.when(F.col("p_size") % 2 == 0, "InGeneList=b;Region=a").when(F.col("p_size") % 3 == 0, "Region=c").otherwise("")
    return annotate.annotation_summary(a.variants(spark, sf_dir).select(text_of_row.alias("Custom_Annotation")))


@query("SELECT variant_id FROM variants WHERE variant_id % 5 IN (1, 3)")
def transcript_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = a.variants(spark, sf_dir).withColumn("FEATUREID", F.concat(F.lit("NM_"), (F.col("variant_id") % 5).cast("string"), F.lit(".2")))
    return annotate.of_transcripts(v, ["NM_1", "NM_3.9"]).select("variant_id")


@query("SELECT sample_id, n_name || '-' || lpad((row_number() OVER (ORDER BY sample_id))::VARCHAR, greatest(4, length((row_number() OVER (ORDER BY sample_id))::VARCHAR))::INT, '0') AS pseudonym FROM samples JOIN nation ON n_nationkey = s_nationkey")
def pseudonym_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.samples(spark, sf_dir).join(a.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return identifiers.custom(rows, "{n_name}-{index:04d}")


@query(", n AS (SELECT sample_id, 'P' || (row_number() OVER (ORDER BY sample_id))::VARCHAR AS p FROM samples) SELECT variant_id, string_agg(p || '(' || gt || ')', ';' ORDER BY c.sample_id) AS \"GT\" FROM calls c JOIN n ON n.sample_id = c.sample_id GROUP BY variant_id")
def pseudonymised_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample ids inside packed cells under their pseudonyms."""
    return identifiers.pseudonymised_text(annotate.packed(a.calls(spark, sf_dir)), ["GT"], identifiers.custom(a.samples(spark, sf_dir), "P{index}"))


@query(", n AS (SELECT sample_id, 'P' || (row_number() OVER (ORDER BY sample_id))::VARCHAR AS p FROM samples) SELECT variant_id, p AS sample_id, dosage FROM calls c JOIN n ON n.sample_id = c.sample_id")
def pseudonymised_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identifiers.pseudonymised_calls(a.calls(spark, sf_dir), identifiers.custom(a.samples(spark, sf_dir), "P{index}")).select("variant_id", "sample_id", "dosage")


TERMS = "CASE WHEN s_nationkey % 3 = 0 THEN '' WHEN s_nationkey % 3 = 1 THEN 'HP:1' ELSE 'HP:1,HP:2' END"


def nation_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_nationkey") % 3
    return a.samples(spark, sf_dir).select("sample_id", "place", F.when(k == 1, F.array(F.lit("HP:1"))).when(k == 2, F.array(F.lit("HP:2"), F.lit("HP:1"))).alias("terms"))


@query(f"SELECT variant_id, string_agg(c.sample_id || '(' || {TERMS} || ')', ';' ORDER BY c.sample_id) AS phenotypes FROM calls c JOIN samples s ON s.sample_id = c.sample_id GROUP BY variant_id")
def phenotype_text_of_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.packed_phenotype_text(annotate.packed(a.calls(spark, sf_dir)), nation_terms(spark, sf_dir).select("sample_id", "terms"))


@query(f"SELECT string_agg({TERMS}, ';' ORDER BY place) AS joined, string_agg(sample_id || '(' || {TERMS} || ')', ';' ORDER BY place) AS like_genotypes FROM samples")
def phenotypes_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = a.samples(spark, sf_dir).select("sample_id", "place"), nation_terms(spark, sf_dir).select("sample_id", "terms")
    one, two = annotate.phenotypes_of(s, t).withColumn("k", F.lit(1)), annotate.phenotypes_like_genotypes(s, t).select(F.col("phenotypes").alias("like_genotypes"), F.lit(1).alias("k"))
    return one.join(two, "k").select(F.col("phenotypes").alias("joined"), "like_genotypes")


@query(f"SELECT sample_id, {TERMS} AS terms FROM samples")
def phenotypes_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of a cell belong to the samples in their order; a cell with another number of groups is passed over."""
    s = a.samples(spark, sf_dir).select("sample_id", "place")
    cell = annotate.phenotypes_like_genotypes(s, nation_terms(spark, sf_dir).select("sample_id", "terms"))
    rows = cell.union(spark.createDataFrame([("only(one)",)], "phenotypes string"))
    ids = [r.sample_id for r in s.orderBy("place").collect()]
    return annotate.aligned_phenotypes(rows, ids).select("sample_id", F.array_join("terms", ",").alias("terms"))


@query(", n AS (SELECT variant_id, gt, count(*) AS n FROM (SELECT variant_id, CASE dosage WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' ELSE '1/1' END AS gt FROM all_calls) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY n DESC, gt) AS i FROM n) SELECT variant_id, string_agg(gt, ',' ORDER BY i) AS gt FROM r WHERE i <= 2 GROUP BY variant_id")
def merged_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.two_commonest(a.all_calls(spark, sf_dir))


@query("""SELECT variant_id, chrom || ':' || pos || ':' || ref || '>' || alt AS key, 'ENSG' || variant_id AS ensembl, CASE p_size % 4 WHEN 0 THEN 'stop_gained' WHEN 1 THEN 'missense_variant' ELSE 'intron_variant' END AS leading, CASE WHEN p_size % 3 = 0 THEN 'NA' ELSE 'G' || p_size END AS nmd, 'a b c' AS clean FROM variants""")
def text_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("variant_id").cast("string"), F.col("p_size")
    effect = F.when(size % 4 == 0, "intron_variant&missense_variant&stop_gained").when(size % 4 == 1, "intron_variant&missense_variant").otherwise("intron_variant&x")
    nmd = F.when(size % 3 != 0, F.concat(F.lit("G"), size.cast("string"), F.lit("|x|2|0.5,H|y")))
    v = a.variants(spark, sf_dir)
    return v.select(
        "variant_id", genotype.variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")).alias("key"), text.ensembl_gene(F.concat(F.lit("x-ENSG"), k, F.lit(".4"))).alias("ensembl"),
        text.leading_effect(effect).alias("leading"), text.nmd_subfield(nmd).alias("nmd"), text.metadata_field(F.lit(" a\tb\nc ")).alias("clean"),
    )


@query("SELECT * FROM (VALUES ('GEN[3].DP', 'DP_3'), ('GEN[0].AF', 'AF_0'), ('GEN[*].GT', 'GT'), ('ANN[0].GENE', 'GENE'), ('ANN[*].GENE', 'GENE'), ('NMD[0].PERC', 'NMD_PERC'), ('LOF[*].PERC', 'LOF_PERC'), ('CHROM', 'CHROM')) t(name, short)", base=False)
def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["GEN[3].DP", "GEN[0].AF", "GEN[*].GT", "ANN[0].GENE", "ANN[*].GENE", "NMD[0].PERC", "LOF[*].PERC", "CHROM"]
    return spark.createDataFrame([(n, text.header_name(n)) for n in names], "name string, short string")


@query("SELECT * FROM (VALUES ('a/my genes.txt', 'my_genes'), ('x.genes.list', 'x'), ('2nd.tsv', 'list_2nd'), ('---.txt', 'unnamed_list'), ('A.gene', 'A')) t(path, name)", base=False)
def list_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(p, text.list_name(p)) for p in ("a/my genes.txt", "x.genes.list", "2nd.tsv", "---.txt", "A.gene")], "path string, name string")


@query("SELECT variant_id, gene AS \"GENE\", effect AS \"EFFECT\", try_cast(cadd::VARCHAR AS DOUBLE) AS \"CADD_phred\", NULL::DOUBLE AS \"x_score\" FROM variants")
def table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short names are added, named and samples' columns go, columns that hold numbers by their names become numbers."""
    v = a.variants(spark, sf_dir)
    df = v.select("variant_id", F.col("gene").alias("ANN_0__GENE"), F.col("effect").alias("ANN_0__EFFECT"), F.lit("0/1").alias("GEN_0__GT"), F.lit("0/1").alias("S1"), F.col("cadd").cast("string").alias("CADD_phred"), F.lit("none").alias("x_score"), F.lit(1).alias("drop_me"))
    df = annotate.without_samples(annotate.with_aliases(df), ["S1"])
    return annotate.as_numbers(annotate.without_columns(df, ["drop_me", "absent", "ANN_0__GENE", "ANN_0__EFFECT"]))


@query("SELECT 'p_brand' AS name, count(DISTINCT p_brand)::BIGINT AS n_distinct, round(count(DISTINCT p_brand) / count(*), 6) AS share, count(DISTINCT p_brand) / count(*) < 0.5 AS repeated FROM part UNION ALL SELECT 'p_partkey', count(DISTINCT p_partkey), round(count(DISTINCT p_partkey) / count(*), 6), FALSE FROM part", base=False)
def column_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotate.cardinality(a.table(spark, sf_dir, "part"), ["p_brand", "p_partkey"])
    return rows.select("name", "n_distinct", r6("share", "share"), "repeated")


@query("SELECT p_brand AS variant_id, min(p_type) AS gene FROM part GROUP BY p_brand", base=False)
def first_row_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.table(spark, sf_dir, "part").select(F.col("p_brand").alias("variant_id"), F.col("p_type").alias("gene"), "p_size")
    return annotate.first_rows(rows).drop("p_size")


@query("SELECT p_partkey::VARCHAR AS \"P\", p_brand AS \"B\" FROM part WHERE (p_size <= 10 OR p_brand = 'Brand#13') AND NOT p_type LIKE '%BRASS%'", base=False)
def table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter expression over the columns of a delimited table."""
    from helicase.plans import filterlang

    path = written(spark, "t", a.table(spark, sf_dir, "part").select(tabbed("p_partkey", "p_brand", "p_size", "p_type")), ["P\tB\tS\tT"], "tsv")
    return filterlang.table_filter(tables.read_delimited(spark, path), "((S <= 10) | (B = 'Brand#13')) & !(T =~ 'BRASS')").select("P", "B")


@query("SELECT * FROM (VALUES ('dbnsfp4', 'dbNSFP v4.x (gnomAD v3/v4.0, separate exome+genome)'), ('dbnsfp5', 'dbNSFP v5.x (gnomAD v4.1, joint exome+genome)')) t(name, description)", base=False)
def annotation_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helicase.plans.filterlang import profiles

    return spark.createDataFrame([(p["name"], p["description"]) for p in profiles()], "name string, description string")


# inheritance


@query("SELECT variant_id, sample_id, CASE dosage WHEN 0 THEN 'reference' WHEN 2 THEN 'homozygous' ELSE 'unknown' END AS pattern FROM all_calls")
def single_sample_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inheritance.single_samples(a.all_calls(spark, sf_dir))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN f1 = -1 OR m1 = -1 OR f2 = -1 OR m2 = -1 THEN 'unknown' WHEN (f1 > 0 AND m1 = 0 AND f2 = 0 AND m2 > 0) OR (f1 = 0 AND m1 > 0 AND f2 > 0 AND m2 = 0) THEN 'trans'
  WHEN (f1 > 0 AND f2 > 0 AND m1 = 0 AND m2 = 0) OR (m1 > 0 AND m2 > 0 AND f1 = 0 AND f2 = 0) THEN 'cis' WHEN (f1 > 0 AND m1 > 0) OR (f2 > 0 AND m2 > 0) THEN 'ambiguous' ELSE 'unknown' END AS phase,
  CASE WHEN f1 = -1 OR m1 = -1 OR f2 = -1 OR m2 = -1 THEN 'compound_heterozygous_possible_missing_parent_genotypes' WHEN (f1 > 0 AND m1 = 0 AND f2 = 0 AND m2 > 0) OR (f1 = 0 AND m1 > 0 AND f2 > 0 AND m2 = 0) THEN 'compound_heterozygous'
  WHEN (f1 > 0 AND f2 > 0 AND m1 = 0 AND m2 = 0) OR (m1 > 0 AND m2 > 0 AND f1 = 0 AND f2 = 0) THEN 'not_compound_heterozygous' ELSE 'compound_heterozygous_possible' END AS type
  FROM (SELECT l_orderkey, l_linenumber, l_partkey % 4 - 1 AS f1, l_suppkey % 3 AS m1, l_orderkey % 3 AS f2, l_linenumber % 4 - 1 AS m2 FROM lineitem)""", base=False)
def pair_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    told = inheritance.pair_type(c("l_partkey") % 4 - 1, c("l_suppkey") % 3, c("l_orderkey") % 3, c("l_linenumber") % 4 - 1)
    return a.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", told["phase"].alias("phase"), told["type"].alias("type"))


@query(""", t AS (SELECT c.variant_id, p.sample_id, p.place, m.sample_id IS NOT NULL AS known, coalesce(cm.dosage, 0) > 0 AS given FROM calls c JOIN pedigree p ON p.sample_id = c.sample_id LEFT JOIN pedigree m ON m.sample_id = p.mother_id LEFT JOIN calls cm ON cm.variant_id = c.variant_id AND cm.sample_id = p.mother_id)
 SELECT variant_id, bool_or(NOT known OR given) AS mitochondrial FROM t GROUP BY variant_id""")
def mitochondrial_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = a.variants(spark, sf_dir).withColumn("chrom", F.lit("chrM"))
    return inheritance.patterns(a.calls(spark, sf_dir), v, fam(spark, sf_dir)).select("variant_id", F.array_contains("patterns", "mitochondrial").alias("mitochondrial"))


@query("""SELECT c.variant_id, string_agg(c.sample_id || ':' || gt || ':' || p.affected::INT, ',' ORDER BY p.place) AS carriers, count(*) FILTER (WHERE p.affected)::BIGINT AS affected_count, count(*) FILTER (WHERE c.dosage = 1 AND NOT p.affected)::BIGINT AS carrier_count FROM calls c JOIN pedigree p ON p.sample_id = c.sample_id GROUP BY c.variant_id""")
def inheritance_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carriers as the details tell them."""
    rows = inheritance.analysed(a.calls(spark, sf_dir), a.variants(spark, sf_dir), fam(spark, sf_dir), detailed=True)
    d = F.from_json("details", "struct<samples_with_pattern:array<struct<sample_id:string,genotype:string,affected:boolean>>,affected_count:bigint,carrier_count:bigint>")
    told = rows.select("variant_id", d.alias("d")).where(F.size("d.samples_with_pattern") > 0)
    cell = F.transform("d.samples_with_pattern", lambda x: F.concat_ws(":", x["sample_id"], x["genotype"], x["affected"].cast("int").cast("string")))
    return told.select("variant_id", F.array_join(cell, ",").alias("carriers"), "d.affected_count", "d.carrier_count")


@query("SELECT impact AS pattern, count(*)::BIGINT AS n FROM variants GROUP BY impact")
def pattern_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inheritance.pattern_counts(a.variants(spark, sf_dir), "impact")


@query("SELECT p.family_id, string_agg(p.sample_id, ',' ORDER BY p.sample_id) AS members, count(*) FILTER (WHERE affected)::BIGINT AS affected, count(nullif(father_id, '0'))::BIGINT AS fathers FROM pedigree p GROUP BY p.family_id")
def pedigree_accessors(spark: SparkSession, sf_dir: str) -> DataFrame:
    ped = a.pedigree(spark, sf_dir)
    hit = inheritance.affected_of(ped).groupBy("family_id").agg(F.count("*").alias("affected"))
    fathers = inheritance.parents_of(ped).join(ped.select("sample_id", "family_id"), "sample_id").groupBy("family_id").agg(F.count("father_id").alias("fathers"))
    rows = inheritance.members_of(ped).join(hit, "family_id", "left").join(fathers, "family_id")
    return rows.select("family_id", F.array_join("members", ",").alias("members"), F.coalesce("affected", F.lit(0)).alias("affected"), "fathers")


# association


@query(", n AS (SELECT count(*) AS n FROM samples), mc AS (SELECT variant_id, gene, sample_id, CASE WHEN (variant_id * 31 + substr(sample_id, 2)::BIGINT) % 11 = 0 THEN NULL ELSE dosage END AS dosage FROM all_calls), bad AS (SELECT variant_id FROM mc GROUP BY variant_id HAVING count(*) FILTER (WHERE dosage IS NULL)::DOUBLE / (SELECT n FROM n) > 0.03), k AS (SELECT * FROM mc WHERE variant_id NOT IN (SELECT variant_id FROM bad)), v AS (SELECT gene, count(DISTINCT variant_id) AS n FROM k GROUP BY gene), m AS (SELECT gene, sample_id, count(DISTINCT variant_id) AS m FROM k WHERE dosage IS NULL GROUP BY gene, sample_id), f AS (SELECT variant_id, coalesce(sum(dosage), 0)::DOUBLE / nullif(2 * ((SELECT n FROM n) - count(*) FILTER (WHERE dosage IS NULL)), 0) AS maf FROM k GROUP BY variant_id) SELECT k.variant_id, k.sample_id, coalesce(k.dosage::DOUBLE, round(2 * maf)) AS dosage, coalesce(m.m::DOUBLE / v.n > 0.05, FALSE) AS masked FROM k JOIN v ON v.gene = k.gene JOIN f ON f.variant_id = k.variant_id LEFT JOIN m ON m.gene = k.gene AND m.sample_id = k.sample_id")
def gene_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of genes' matrices: sites and samples by what they miss, missing ones imputed."""
    n = a.samples(spark, sf_dir).count()
    rows = association.imputed(association.observed(missing_calls(spark, sf_dir), n, 0.03, 0.05), n)
    return rows.select("variant_id", "sample_id", "dosage", "masked")


@query("SELECT gene, CASE WHEN count(DISTINCT b.sample_id) FILTER (WHERE is_case) < 10 THEN 'LOW_CASE_CARRIERS' ELSE '' END AS warnings FROM calls b JOIN samples s ON s.sample_id = b.sample_id GROUP BY gene")
def low_carrier_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return burden.few_carriers(burden.gene_counts(a.calls(spark, sf_dir), a.cohort(spark, sf_dir))).select("gene", "warnings")


@query("SELECT count(*) FILTER (WHERE is_case) < 10 AS refused, count(*) FILTER (WHERE is_case) BETWEEN 10 AND 49 AS no_power, count(*) FILTER (WHERE is_case) BETWEEN 10 AND 199 AS low, count(*) FILTER (WHERE is_case) >= 10 AND count(*) FILTER (WHERE NOT is_case) > 20 * count(*) FILTER (WHERE is_case) AS lopsided FROM samples")
def cohort_size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    try:
        notes, refused = burden.checked(*burden.cohort_sizes(a.cohort(spark, sf_dir))), False
    except ValueError:
        notes, refused = [], True
    return spark.createDataFrame([(refused, "NO_PRACTICAL_POWER" in notes, "LOW_CASE_COUNT" in notes, "IMBALANCED_COHORT" in notes)], "refused boolean, no_power boolean, low boolean, lopsided boolean")


@query("SELECT p_partkey::VARCHAR AS gene, CASE WHEN p_size % 10 >= 5 THEN 'gained' ELSE 'lost' END AS change FROM part WHERE (p_size % 10 >= 5) <> (p_size % 7 >= 5)", base=False)
def weight_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = lambda c: F.when(c, F.lit(0.2)).otherwise(F.lit(0.01))
    rows = a.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("gene"), q(F.col("p_size") % 10 >= 5).alias("q_plain"), q(F.col("p_size") % 7 >= 5).alias("q_weighted"))
    return association.weight_gains(rows).select("gene", "change")


@query("SELECT variant_id, 1.0::DOUBLE AS uniform, round(25 * power(1 - greatest(af, 1e-8), 24) * least(cadd / 40, 1), 6) AS combined, round(25 * power(1 - greatest(af, 1e-8), 24) * revel, 6) AS by_revel, round(25 * power(1 - greatest(af, 1e-8), 24), 6) AS plain FROM variants")
def weight_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helicase.functions import weights

    af, cadd, revel = F.col("af"), F.col("cadd"), F.col("revel")
    return a.variants(spark, sf_dir).select("variant_id", weights.by_spec("uniform", af).alias("uniform"), r6(weights.by_spec("combined", af, cadd, revel), "combined"), r6(weights.by_spec("combined", af, None, revel), "by_revel"), r6(weights.by_spec("combined", af), "plain"))


@query(", cat AS (SELECT variant_id, gene, CASE WHEN impact = 'HIGH' AND effect = 'stop_gained' THEN 3 WHEN effect = 'missense_variant' AND (sift = 'deleterious' OR polyphen <> 'benign') THEN 2 WHEN effect = 'missense_variant' AND sift = 'tolerated' AND polyphen = 'benign' THEN 1 ELSE 0 END AS c FROM variants WHERE variant_id IN (SELECT variant_id FROM calls)) SELECT gene, CASE count(DISTINCT c) FILTER (WHERE c > 0) WHEN 3 THEN 'complete' WHEN 0 THEN 'skipped' ELSE 'partial' END AS status FROM cat GROUP BY gene")
def allelic_series_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which genes have all, some or none of the categories, as the test tells it."""
    cohort = genetests.Cohort.of(a.samples(spark, sf_dir).select("sample_id", (F.col("place") % 2).alias("y")))
    rows = a.calls(spark, sf_dir).join(coast_classify(spark, sf_dir), "variant_id").withColumn("weight", F.lit(1.0))
    return association.test_genes(rows, cohort, ["coast"]).select("gene", "status")


@query(", b AS (SELECT gene, sample_id, sum(dosage)::DOUBLE AS b FROM calls GROUP BY gene, sample_id), full_b AS (SELECT g.gene, s.s_acctbal::DOUBLE AS y, coalesce(b.b, 0) AS b FROM (SELECT DISTINCT gene FROM calls) g CROSS JOIN samples s LEFT JOIN b ON b.gene = g.gene AND b.sample_id = s.sample_id), r AS (SELECT gene, regr_slope(y, b) AS slope, sqrt(greatest(regr_syy(y, b) - regr_slope(y, b) * regr_sxy(y, b), 0) / (count(*) - 2) / regr_sxx(y, b)) AS se FROM full_b GROUP BY gene HAVING regr_sxx(y, b) > 0) SELECT gene, round(slope + 0.000123, 2) AS effect, round(se + 0.000123, 2) AS se, round(slope - 1.959963984540054 * se + 0.000123, 2) AS ci_lower FROM r")
def linear_burden_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = QUERIES["linear_burden_full"](spark, sf_dir).where("effect IS NOT NULL")
    return rows.select("gene", *(F.round(F.col(c) + 0.000123, 2).alias(c) for c in ("effect", "se", "ci_lower")))


def carrier_share(sums: genetests.GeneSums) -> dict:
    """A test of one's own for registration: the share of samples that carry anything."""
    return {"p_value": sums.carriers / sums.n, "warnings": ""}


@query("SELECT gene, round(count(DISTINCT sample_id)::DOUBLE / (SELECT count(*) FROM samples), 6) AS share FROM calls GROUP BY gene")
def registered_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    association.register("carrier_share", carrier_share)
    rows = association.run_all(a.calls(spark, sf_dir), a.cohort(spark, sf_dir), ["carrier_share"], plan=association.Plan(least_alleles=0, least_cases=1))
    return rows.select("gene", r6("carrier_share_pvalue", "share"))


@query(", n AS (SELECT count(*) FILTER (WHERE is_case) AS n1, count(*) FILTER (WHERE NOT is_case) AS n0 FROM samples), g AS (SELECT gene, count(DISTINCT c.sample_id) FILTER (WHERE is_case) AS a, count(DISTINCT c.sample_id) FILTER (WHERE NOT is_case) AS b FROM calls c JOIN samples s ON s.sample_id = c.sample_id GROUP BY gene) SELECT gene, round(ln((a + 0.5) * (n0 - b + 0.5) / ((n1 - a + 0.5) * (b + 0.5))), 3) AS effect FROM g, n WHERE a + b < n1 + n0")
def firth_burden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The penalty adds one half to each cell of a two by two table."""
    cohort = genetests.Cohort.of(a.cohort(spark, sf_dir).select("sample_id", F.col("is_case").cast("double").alias("y")))
    rows = a.calls(spark, sf_dir).withColumns({"weight": F.lit(1.0), "category": F.lit(0), "masked": F.lit(False)})
    changed = genetests.changes(genetests.carriers(rows), cohort, {"carriers": [(F.size("has") > 0).cast("double")]})
    keys = changed.groupBy("gene", "test").agg(F.sum(F.when(F.col("b0") > 0, F.col("n"))).alias("on"))
    keys = keys.where(F.col("on") < cohort.n)
    fits = genetests.fitted(keys, changed, cohort, ["b0"], True)
    return fits.select("gene", F.round(F.get("beta", F.lit(1)), 3).alias("effect"))


@query(PRIORITISED + " SELECT v.variant_id, coalesce(pattern, 'unknown') AS \"Inheritance_Pattern\", printf('%.2f', coalesce(confidence, 0.0)::DOUBLE) AS \"Inheritance_Confidence\", (SELECT string_agg(sample_id, ',' ORDER BY sample_id) FROM calls c WHERE c.variant_id = v.variant_id) AS \"Inheritance_Samples\" FROM variants v LEFT JOIN best b ON b.variant_id = v.variant_id")
def inheritance_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result as text columns."""
    rows = inheritance.analysed(a.calls(spark, sf_dir), a.variants(spark, sf_dir), fam(spark, sf_dir))
    return inheritance.as_columns(rows, "columns").select("variant_id", "Inheritance_Pattern", "Inheritance_Confidence", "Inheritance_Samples")


@query("SELECT * FROM (VALUES ('identifier', '1.AF/x', 'col_1_AF_x'), ('annotation', 'my-set..v2', 'my_set_v2'), ('output', 'a/b.vcf.gz', 'b.G1'), ('short', 'a b/c', 'a_b_c'), ('fields', 'CHROM POS AF', 'CHROM POS AF AC'), ('reads inheritance', 'p', 'true'), ('reads inheritance', 'z', 'false')) t(kind, given, told)", base=False)
def made_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = lambda f: {"variables": {"Inheritance_Pattern": "p", "Z": "z"}, "formulas": [{"a": f"{f} + 1"}]}
    rows = [("identifier", "1.AF/x", text.identifier("1.AF/x")), ("annotation", "my-set..v2", text.annotation_name("my-set..v2")), ("output", "a/b.vcf.gz", text.output_name("a/b.vcf.gz", "G1")), ("short", "a b/c", text.short_name("a b/c")), ("fields", "CHROM POS AF", text.with_fields("CHROM POS AF", ["AF", "AC"]))]
    rows += [("reads inheritance", f, str(scoring.needs_inheritance(model(f))).lower()) for f in "pz"]
    return spark.createDataFrame(rows, "kind string, given string, told string")


# checks and steps


@query("SELECT * FROM (VALUES ('correction_method is none of fdr, bonferroni: ''x'''), ('min_cases is not of kind int: ''a'''), ('no such weights: odd'), ('unknown setting nope'), ('gene JSON needs a mapping'), ('no such file: /absent.json')) t(fault)", base=False)
def settings_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    faults = config.association_faults({"nope": 1, "correction_method": "x", "min_cases": "a", "variant_weights": "odd", "pca_components": 3})
    faults += config.annotation_faults(spark, gene_json=["/absent.json"])
    return spark.createDataFrame([(f,) for f in faults], "fault string")


@query("SELECT * FROM (VALUES (1, 'a', 'made', 25), (1, 'b', 'made', 5), (2, 'a', 'found', 25), (2, 'b', 'found', 5), (3, 'a', 'found', 25), (3, 'b', 'made', 5), (4, 'a', 'made', 25), (4, 'b', 'made', 5)) t(run, step, state, n)", base=False)
def resumed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs over one folder: the first makes all, the second finds all, the third begins anew at b, the fourth has other
    settings."""
    from helicase.plans.steps import Steps

    folder, out = shared_dir(spark, "steps"), []
    for run, (settings, restart) in enumerate((({"x": 1}, None), ({"x": 1}, None), ({"x": 1}, "b"), ({"x": 2}, None)), 1):
        steps = Steps(spark, folder, settings, restart=restart)
        first = steps.step("a", lambda: a.table(spark, sf_dir, "nation"))
        second = steps.step("b", lambda first=first: first.select("n_regionkey").distinct())
        out += [(run, n, state, size) for (n, state), size in zip(steps.done, (first.count(), second.count()), strict=True)]
    return spark.createDataFrame(out, "run int, step string, state string, n int")


@query("SELECT 'total_variants' AS metric, count(*)::DOUBLE AS value FROM variants UNION ALL SELECT 'total_genes', count(DISTINCT gene) FROM variants UNION ALL SELECT 'total_samples', 0 UNION ALL SELECT 'high_impact_count', count(*) FILTER (WHERE impact = 'HIGH') FROM variants UNION ALL SELECT 'moderate_impact_count', count(*) FILTER (WHERE impact = 'MODERATE') FROM variants")
def default_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.configured(a.table_of(a.variants(spark, sf_dir)))["dataset"]


@query("SELECT gene AS \"GENE\", count(*)::DOUBLE AS variant_count, count(*) FILTER (WHERE impact = 'HIGH')::DOUBLE AS high_impact_variants FROM variants GROUP BY gene")
def default_gene_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.configured(a.table_of(a.variants(spark, sf_dir)))["genes"]


@query("SELECT gene AS \"GENE\", count(*)::DOUBLE AS n, NULL::DOUBLE AS m FROM variants GROUP BY gene UNION ALL SELECT impact, NULL, count(*)::DOUBLE FROM variants GROUP BY impact")
def united_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = a.table_of(a.variants(spark, sf_dir))
    one = v.groupBy("GENE").agg(F.count("*").cast("double").alias("n"))
    return statistics.united([one, v.groupBy(F.col("IMPACT").alias("GENE")).agg(F.count("*").cast("double").alias("m"))])
