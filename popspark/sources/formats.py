"""Readers and writers of the field's text formats.  Plain or gzip; a path may be a file, a folder or a glob.

Writers give folders of text files whose parts, put one after the other, are one valid file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.intervals import PART_ROWS
from ..operators.reads import natural_key

#: The columns of a haplotype report, in file order, and their types.
HAP_STATS = {
    "locus": "string", "sites": "long", "haplotypes": "long", "inds_haplotyped": "long", "total_inds": "long", "prop_haplotyped": "double",
    "status": "string", "poss_paralog": "long", "low_cov_geno_err": "long", "miss_geno": "long", "comment": "string",
}


def read_lines(spark: SparkSession, path: str, schema: str = "value string") -> DataFrame:
    return spark.read.schema(schema).option("lineSep", "\n").text(path)


def _field(i: int, kind: str = "string") -> Column:
    """Field i (from 0) of a tab-separated line; null if the line is shorter or the text isn't of that kind."""
    text = F.get(F.split("value", "\t"), F.lit(i))
    return text if kind == "string" else text.try_cast(kind)


def _tabbed(*columns: str | Column) -> Column:
    """Columns as one tab-separated line; null is a full stop."""
    return F.concat_ws("\t", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(".")) for c in columns]).alias("value")


def _ordered(df: DataFrame, *keys: Column) -> DataFrame:
    """df in ranges of the keys, sorted.  Tables of more than PART_ROWS rows for each of the session's partitions have as many more ranges; df is counted for that."""
    parts = df.count() // PART_ROWS + 1
    own = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(parts, *keys) if parts > own else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)


def write_fasta(contigs: DataFrame, path: str) -> None:
    """contig and seq as two lines each, contigs in natural order; a null sequence is empty."""
    line = F.concat(F.lit(">"), "contig", F.lit("\n"), F.coalesce("seq", F.lit(""))).alias("value")
    _ordered(contigs.where("contig IS NOT NULL"), *natural_key(F.col("contig"))).select(line).write.text(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """contig (the header's first word) and seq; sequence lines are put together."""
    record = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    return record.select(F.regexp_extract("value", r"^(\S*)", 1).alias("contig"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*", ""), r"\s", "").alias("seq"))


def write_bed(intervals: DataFrame, path: str, *more: str) -> None:
    """contig, start, end and further columns, in natural order of contigs."""
    _ordered(intervals, *natural_key(F.col("contig")), F.col("start"), F.col("end")).select(_tabbed("contig", "start", "end", *more)).write.text(path)


def read_bed(spark: SparkSession, path: str, **more: str) -> DataFrame:
    """contig, start, end and the columns named in more (name=type); comment, track and browser lines are left out."""
    own = read_lines(spark, path).where(~F.col("value").rlike(r"^(#|track\s|browser\s|\s*$)"))
    return own.select(_field(0).alias("contig"), _field(1, "long").alias("start"), _field(2, "long").alias("end"), *[_field(3 + i, kind).alias(name) for i, (name, kind) in enumerate(more.items())])


def write_sam(aln: DataFrame, path: str) -> None:
    """Alignments (sample, contig, pos, mapq, flag, cigar, rnext; name, seq and qual if there) with their read groups, by contig and position."""
    has = lambda c: F.col(c) if c in aln.columns else F.lit("*")
    line = F.concat(_tabbed(has("name"), "flag", "contig", "pos", "mapq", "cigar", "rnext", F.lit(0), F.lit(0), has("seq"), has("qual")), F.lit("\tRG:Z:"), "sample").alias("value")
    rows = aln.select(F.lit(1).alias("part"), *[k.alias(n) for k, n in zip(natural_key(F.col("contig")), ("text", "number"))], "pos", line)
    groups = aln.select("sample").distinct().select(F.lit(0).alias("part"), F.lit("").alias("text"), F.lit(0).alias("number"), F.lit(0).alias("pos"), F.concat(F.lit("@RG\tID:"), "sample", F.lit("\tSM:"), "sample").alias("value"))
    _ordered(groups.union(rows), *map(F.col, ("part", "text", "number", "pos"))).select("value").write.text(path)


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """sample (from the read group), name, flag, contig, pos, mapq, cigar, rnext, seq, qual."""
    kinds = {"name": (0, "string"), "flag": (1, "long"), "contig": (2, "string"), "pos": (3, "long"), "mapq": (4, "long"), "cigar": (5, "string"), "rnext": (6, "string"), "seq": (9, "string"), "qual": (10, "string")}
    sample = F.nullif(F.regexp_extract("value", r"\tRG:Z:([^\t]+)", 1), F.lit("")).alias("sample")
    return read_lines(spark, path).where("value NOT LIKE '@%' AND value <> ''").select(sample, *[_field(i, k).alias(n) for n, (i, k) in kinds.items()])


def write_uniq(uniq: DataFrame, path: str) -> None:
    """count and sequence, a folder for each sample."""
    uniq.select("sample", F.concat_ws("\t", "n", "seq").alias("value")).write.partitionBy("sample").text(path)


def read_uniq(spark: SparkSession, path: str) -> DataFrame:
    """sample, n, seq of the folders sample=..."""
    two = F.split("value", "\t", 2)
    return read_lines(spark, path, "value string, sample string").select("sample", two[0].try_cast("long").alias("n"), two[1].alias("seq"))


def read_hap_stats(spark: SparkSession, path: str) -> DataFrame:
    """The eleven columns of a haplotype report; a hyphen is null."""
    own = read_lines(spark, path).where("value NOT LIKE 'Locus\t%' AND value <> ''")
    plain = own.select(*[F.nullif(_field(i), F.lit("-")).alias(c) for i, c in enumerate(HAP_STATS)])
    return plain.select(*[F.col(c).try_cast(k).alias(c) for c, k in HAP_STATS.items()])


def write_fastq(reads: DataFrame, path: str, *order: str) -> None:
    """name, seq and qual of reads in the given order, in folders sample=.../mate=...; gzip."""
    line = F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")
    _ordered(reads, *map(F.col, ("sample", "mate", *order))).select("sample", "mate", line).write.partitionBy("sample", "mate").option("compression", "gzip").text(path)


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """sample, mate, ordinal (from 0 within both), name, seq, qual.

    Sample and mate come from folders sample=.../mate=..., else from names like S_1.F.fq.gz and S_1.R.fq.gz.  A line's
    number is its place in its block of the file plus the lines of all blocks and files before it, so that large plain
    files are read in many tasks, and records that reach over two blocks come together again.
    """
    name, folder = F.col("_metadata.file_path"), r"/sample=([^/]*)/mate=(\d)/"
    own = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path).select(
        F.when(name.rlike(folder), F.url_decode(F.regexp_extract(name, folder, 1))).otherwise(F.regexp_extract(name, r"([^/]+)\.[FR]\.(fq|fastq)(\.gz)?$", 1)).alias("sample"),
        F.when(name.rlike(folder), F.regexp_extract(name, folder, 2)).otherwise(F.when(name.rlike(r"\.R\.(fq|fastq)(\.gz)?$"), "2").otherwise("1")).cast("long").alias("mate"),
        name.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value",
    )
    blocks = own.groupBy("sample", "mate", "file", "block").agg(F.min("id").alias("first"), F.count("*").alias("lines"))
    before = W.partitionBy("sample", "mate").orderBy("file", "block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"))
    numbered = own.join(blocks, ["file", "block"]).withColumn("at", F.expr("before + id - first"))
    part = lambda i: F.max(F.when(F.expr("at % 4") == i, F.col("value")))
    return numbered.groupBy("sample", "mate", F.expr("at div 4").alias("ordinal")).agg(F.substring(part(0), 2, 1 << 30).alias("name"), part(1).alias("seq"), part(3).alias("qual"))


_FIXED = ["chrom", "pos", "ref", "alts", "qual", "filter"]


#: The types of a VCF header and those of columns.
VCF_TYPES = {"Integer": "long", "Float": "double", "Flag": "boolean", "Character": "string", "String": "string"}


def _declared(df: DataFrame, columns: list[str], kind: str, numbers: dict[str, str]) -> list[str]:
    """A header line for each of these columns, typed as the column is.  numbers: A, R, G or a count by column; else 1, of arrays unknown."""
    names = {"long": "Integer", "bigint": "Integer", "int": "Integer", "smallint": "Integer", "tinyint": "Integer", "double": "Float", "float": "Float", "boolean": "Flag"}
    types, lines = dict(df.dtypes), []
    for c in columns:
        listed = types[c].startswith("array<")
        own = types[c][6:-1] if listed else types[c]
        own = "Float" if own.startswith("decimal") else names.get(own, "String")
        number = "0" if own == "Flag" else numbers.get(c, "." if listed else "1")
        lines.append(f'##{kind}=<ID={c.upper()},Number={number},Type={own},Description="{c}">')
    return lines


def write_vcf(sites: DataFrame, calls: DataFrame, path: str, info: list[str], form: list[str], numbers: dict[str, str] | None = None, contigs: DataFrame | None = None) -> None:
    """A site table and its calls (one row for each site and sample) as VCF, in natural order of contigs.

    info: columns of sites for the INFO field; form: columns of calls for the FORMAT field, gt first.  Arrays are listed with
    commas, flags (booleans) stand alone.  The header declares both by the columns' types and by numbers (column to A, R, G
    or a count), and the contigs of contigs(contig, length; a null length is left out) or else of the sites.  A sample without a call is ./. there; of repeated calls
    of one sample at a site the first cell by its text is written, and calls of no sample are left out.  Cells are put in place by the samples'
    numbers, so that a line costs as much as it has samples.  The samples' names, one header line, pass through the driver.
    """
    spark, numbers = sites.sparkSession, numbers or {}
    calls = calls.where("sample IS NOT NULL")
    names = sorted(r[0] for r in calls.select("sample").distinct().collect())
    types = {**dict(calls.dtypes), **dict(sites.dtypes)}

    def text(df: DataFrame, c: str) -> Column:
        if not dict(df.dtypes)[c].startswith("array<"):
            return F.col(c).cast("string")
        return F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("."))), ","))

    numbered = spark.createDataFrame(list(enumerate(names)), "_i int, sample string")
    cell = F.concat_ws(":", *[F.coalesce(text(calls, c), F.lit("./." if c == "gt" else ".")) for c in form])
    cells = calls.select("chrom", "pos", "sample", cell.alias("_cell")).join(numbered, "sample").groupBy("chrom", "pos").agg(F.array_sort(F.collect_list(F.struct("_i", "_cell"))).alias("_cells"))
    before = lambda k: F.coalesce(F.get("_cells", k - 1)["_i"], F.lit(-1))
    gap = F.lit("\t./.")
    placed = F.transform("_cells", lambda x, k: F.when(x["_i"] > before(k), F.concat(F.repeat(gap, x["_i"] - before(k) - 1), F.lit("\t"), x["_cell"])).otherwise(""))
    after = F.repeat(gap, F.lit(len(names) - 1) - F.coalesce(F.element_at("_cells", -1)["_i"], F.lit(-1)))
    of = F.when(F.size("_cells") > 0, F.concat(F.array_join(placed, ""), after)).otherwise(F.repeat(gap, F.lit(len(names))))
    keyed = [F.when(F.col(c), c.upper()) if types[c] == "boolean" else F.concat(F.lit(f"{c.upper()}="), text(sites, c)) for c in info]
    listed = lambda c, sep: F.when(F.size(c) > 0, F.array_join(c, sep)).otherwise(".")
    fixed = _tabbed("chrom", "pos", F.lit("."), "ref", listed("alts", ","), "qual", listed("filter", ";"), F.nullif(F.concat_ws(";", *keyed), F.lit("")), F.lit(":".join(c.upper() for c in form)))
    place = [k.alias(n) for k, n in zip(natural_key(F.col("chrom")), ("text", "number"))]
    rows = sites.join(cells, ["chrom", "pos"], "left").select(F.lit(3).alias("part"), *place, "pos", F.concat(fixed, of).alias("value"))

    long = lambda c: F.lit(c).cast("long")
    top = "\n".join(["##fileformat=VCFv4.2", *_declared(sites, info, "INFO", numbers), *_declared(calls, form, "FORMAT", numbers)])
    heads = [(0, top), (2, "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names]))]
    head = spark.createDataFrame(heads, "part int, value string").select("part", F.lit("").alias("text"), long(0).alias("number"), long(0).alias("pos"), "value")
    own = sites.select("chrom").distinct().withColumn("length", F.lit(None).cast("long")) if contigs is None else contigs.select(F.col("contig").alias("chrom"), "length")
    length = F.coalesce(F.concat(F.lit(",length="), F.col("length").cast("string")), F.lit(""))
    own = own.where("chrom IS NOT NULL").select(F.lit(1).alias("part"), *place, long(0).alias("pos"), F.concat(F.lit("##contig=<ID="), "chrom", length, F.lit(">")).alias("value"))
    _ordered(head.union(own).union(rows), *map(F.col, ("part", "text", "number", "pos"))).select("value").write.text(path)


def vcf_header(spark: SparkSession, path: str) -> DataFrame:
    """kind (INFO or FORMAT), id, number and type, as the header lines declare them; of several declarations of an id, the first by text."""
    of = lambda key: F.nullif(F.regexp_extract("value", rf"[<,]{key}=([^,>]*)", 1), F.lit(""))
    lines = read_lines(spark, path).where(r"value RLIKE '^##(INFO|FORMAT)=<'")
    own = lines.select(F.regexp_extract("value", "^##([A-Z]+)", 1).alias("kind"), of("ID").alias("id"), F.coalesce(of("Number"), F.lit(".")).alias("number"), F.coalesce(of("Type"), F.lit("String")).alias("type"))
    return own.where("id IS NOT NULL").groupBy("kind", "id").agg(F.min(F.struct("number", "type")).alias("own")).select("kind", "id", "own.number", "own.type")


def read_typed_vcf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """read_vcf with info and data as structs of the declared fields (names as in the header), and the rest as a map, `other`.

    A field of Number 1 is one value of its type, a Flag is true or false, and all other numbers (A, R, G, a count, unknown)
    give arrays, in which a full stop or what isn't of the type is null.  A field that a site or call lacks is null.  The
    header's declarations pass through the driver: a row for each field, found in a pass over the lines.  Fields whose names differ by case only
    are one column by Spark's rules, so all but the first by code point stay in `other`.
    """
    declared = sorted(map(tuple, vcf_header(spark, path).collect()))
    sites, calls = read_vcf(spark, path)

    def listed(value: Column, to: str) -> Column:
        return F.transform(F.split(value, ","), lambda x: F.nullif(x, F.lit(".")).try_cast(to))

    def typed(df: DataFrame, column: str, kind: str) -> DataFrame:
        fields, ids = {}, set()
        for own, name, number, t in declared:
            if own != kind or name.lower() in ids:
                continue
            ids.add(name.lower())
            value, to = F.nullif(F.try_element_at(column, F.lit(name)), F.lit(".")), VCF_TYPES.get(t, "string")
            if t == "Flag":
                fields[name] = F.map_contains_key(column, name)
            elif number == "1":
                fields[name] = value.try_cast(to)
            else:
                fields[name] = listed(value, to)
        other = F.map_filter(column, lambda k, _: ~k.isin(".", *fields))
        new = F.struct(*[c.alias(n) for n, c in fields.items()]) if fields else F.lit(None).cast("struct<>")
        return df.select(*[c for c in df.columns if c != column], new.alias(column), other.alias("other"))

    return typed(sites, "info", "INFO"), typed(calls, "data", "FORMAT")


def read_vcf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Sites (chrom, pos, id, ref, alts, qual, filter, info as a map) and calls (chrom, pos, sample, gt, a1, a2, data as a map).

    Calls without any value are left out: an absent row is a missing genotype.  A genotype with a missing allele is null.
    """
    lines = read_lines(spark, path)
    head = lines.where("value LIKE '#CHROM\t%'").first()
    names = head[0].split("\t")[9:] if head else []
    own = lines.where("value NOT LIKE '#%' AND value <> ''").select(F.split("value", "\t").alias("f"))
    listed = lambda i, sep: F.when(F.col("f")[i].isin(".", "PASS"), F.array().cast("array<string>")).otherwise(F.split(F.col("f")[i], sep))
    key = [F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("pos")]
    sites = own.select(*key, F.col("f")[2].alias("id"), F.col("f")[3].alias("ref"), listed(4, ",").alias("alts"), F.col("f")[5].try_cast("double").alias("qual"), listed(6, ";").alias("filter"), F.str_to_map(F.col("f")[7], F.lit(";"), F.lit("=")).alias("info"))
    cells = own.select(*key, F.split(F.get("f", F.lit(8)), ":").alias("form"), F.posexplode(F.slice("f", 10, len(names))).alias("i", "cell")) if names else own.select(*key, F.split(F.lit(""), ":").alias("form"), F.lit(0).alias("i"), F.lit(".").alias("cell"))
    full = cells.where(~F.col("cell").rlike(r"^[./|:]*$"))
    values = F.split("cell", ":")
    data = F.map_from_arrays("form", F.transform("form", lambda _, i: F.nullif(F.get(values, i), F.lit("."))))
    calls = full.select("chrom", "pos", F.element_at(F.array(*map(F.lit, names or [""])), F.col("i") + 1).alias("sample"), data.alias("data"))
    allele = lambda i: F.get(F.split(F.try_element_at("data", F.lit("GT")), "[/|]"), F.lit(i)).try_cast("long")
    calls = calls.select("chrom", "pos", "sample", allele(0).alias("a1"), allele(1).alias("a2"), "data")
    return sites, calls.select("chrom", "pos", "sample", F.when(F.col("a1").isNotNull() & F.col("a2").isNotNull(), F.concat_ws("/", "a1", "a2")).alias("gt"), "a1", "a2", "data")


def merge_call_sets(*sets: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Sites and calls of sets with different samples.  A site's columns come from the set with the most alternate alleles there, the first such set on a tie."""

    def counted(n: int, sites: DataFrame, calls: DataFrame) -> DataFrame:
        ac = calls.groupBy("chrom", "pos").agg(F.sum(F.expr("if(a1 > 0, 1, 0) + if(a2 > 0, 1, 0)")).alias("_ac"))
        return sites.join(ac, ["chrom", "pos"], "left").withColumn("_rank", F.struct(F.coalesce("_ac", F.lit(0)).alias("ac"), F.lit(-n).alias("n"))).drop("_ac")

    every = reduce(lambda a, b: a.unionByName(b), [counted(n, s, c) for n, (s, c) in enumerate(sets)])
    more = [c for c in every.columns if c not in ("chrom", "pos", "_rank")]
    best = every.groupBy("chrom", "pos").agg(F.max_by(F.struct(*more), "_rank").alias("_best")).select("chrom", "pos", *[F.col("_best")[c].alias(c) for c in more])
    return best, reduce(lambda a, b: a.unionByName(b), [c for _, c in sets])


def read_popmap(spark: SparkSession, path: str) -> DataFrame:
    """sample, pop and barcode of each line of a file (fields between white space; missing ones are null, a missing pop comes from the name)."""
    parts = F.split(F.trim("value"), r"\s+")
    own = spark.read.text(path).where(F.trim("value") != "").select(parts[0].alias("sample"), F.get(parts, F.lit(1)).alias("pop"), F.get(parts, F.lit(2)).alias("barcode"))
    return own.withColumn("pop", F.coalesce("pop", F.substring_index("sample", "_", 1)))
