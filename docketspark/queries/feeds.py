"""Filing-shaped inputs derived from the test tables.

Nested documents are built in bounded groups: a document covers a fixed range of
a unique key, so its size does not depend on how often a company or form occurs.
"""

from __future__ import annotations

import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.operators.index import index_rows
from docketspark.session import spread
from docketspark.sources.files import locate

# Orders per submission document and per search-result page, suppliers per ticker file.
SUBMISSION_RANGE = 65_536
PAGE_RANGE = 100
# Orders per block of a company's filings.
BLOCK_RANGE = 256
TICKER_RANGE = 1000
# Pages per archive.
ARCHIVE_PAGES = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filing per order."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    form = (
        F.when(F.col("o_orderstatus") == "F", "10-K")
        .when(F.col("o_orderstatus") == "O", "10-Q")
        .otherwise("S-1")
    )
    mark = F.when(F.col("o_orderpriority") == "1-URGENT", "/A").otherwise("")
    kind = key % 5
    suffix = F.when(kind == 0, ".htm").when(kind == 1, ".html").when(kind == 2, ".xml")
    suffix = suffix.when(kind == 3, ".txt").otherwise(".pdf")
    folder = F.when(kind == 2, "xslF345X05/").otherwise("")
    return orders.select(
        key.alias("order_no"),
        padded(F.col("o_custkey"), 10).alias("cik"),
        padded(key, 18).alias("accession_number"),
        form.alias("root_form"),
        F.concat(form, mark).alias("file_type"),
        F.concat(F.lit("001-"), padded(key % 7, 5)).alias("file_number"),
        F.col("o_orderdate").cast("date").cast("string").alias("filing_date"),
        F.concat(folder, F.lit("d"), key.cast("string"), suffix).alias("primary_document"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat catalog, as ``explode_submissions`` gives it."""
    return filings(spark, sf_dir).select(
        "cik",
        F.col("file_type").alias("form_type"),
        "root_form",
        "accession_number",
        F.substring_index("primary_document", "/", -1).alias("main_file_name"),
        F.col("filing_date").cast("date").alias("filing_date"),
        F.array("file_number").alias("file_num"),
    )


def submission_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON submission documents ``v``: the filings of a company in a range of orders."""
    # 20-character accession numbers with dashes, as documents hold them.
    number = F.col("accession_number")
    dashed = F.concat_ws(
        "-", F.substring(number, 1, 10), F.substring(number, 11, 2), F.substring(number, 13, 6)
    )
    filing = F.struct(
        F.col("filing_date").alias("filingDate"),
        dashed.alias("accessionNumber"),
        F.col("file_type").alias("form"),
        F.col("primary_document").alias("primaryDocument"),
        F.col("file_number").alias("fileNumber"),
    )
    grouped = (
        filings(spark, sf_dir)
        .groupBy("cik", F.expr(f"order_no div {SUBMISSION_RANGE}").alias("page"))
        .agg(F.sort_array(F.collect_list(filing), asc=False).alias("f"))
    )
    names = ["form", "accessionNumber", "filingDate", "primaryDocument", "fileNumber"]
    recent = F.struct(*[F.col(f"f.{name}").alias(name) for name in names])
    key = F.regexp_replace("cik", "^0+(?=.)", "")
    doc = F.struct(key.alias("cik"), F.struct(recent.alias("recent")).alias("filings"))
    return grouped.select("cik", "page", F.to_json(doc).alias("v"))


def sharded_submissions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Main documents ``v`` and block documents ``name, v`` of companies whose older filings
    are in blocks, by ranges of orders. Of the blocks some are missing and some not named."""
    names = {
        "form": "file_type", "accessionNumber": "accession_number", "filingDate": "filing_date",
        "primaryDocument": "primary_document", "fileNumber": "file_number",
    }
    filing = F.struct(*[F.col(column).alias(name) for name, column in names.items()])
    rows = filings(spark, sf_dir).withColumn("page", F.expr(f"order_no div {BLOCK_RANGE}"))
    pages = rows.groupBy("cik", "page").agg(F.sort_array(F.collect_list(filing)).alias("f"))
    pages = pages.select("cik", "page", F.struct(*[F.col(f"f.{n}").alias(n) for n in names]).alias("block"))
    last = pages.groupBy("cik").agg(F.max("page").alias("last"))
    placed = pages.join(last, "cik").withColumn(
        "name", F.concat(F.lit("CIK"), "cik", F.lit("-submissions-"), padded(F.col("page"), 6), F.lit(".json"))
    )
    older = placed.where("page < last")
    named = older.where("page % 7 <> 3").groupBy("cik").agg(
        F.collect_list(F.struct("name", F.size("block.form").alias("filingCount"))).alias("files")
    )
    main = placed.where("page = last").join(named, "cik", "left")
    doc = F.struct("cik", F.struct(F.col("block").alias("recent"), "files").alias("filings"))
    blocks = older.where("page % 5 <> 4").select("name", F.to_json("block").alias("v"))
    return main.select(F.to_json(doc).alias("v")), blocks


def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON result envelopes ``v``: pages of hits, and one error per indebted customer."""
    base = filings(spark, sf_dir)
    second = F.concat(F.lit("333-"), padded(F.col("order_no") % 11, 5))
    numbers = F.when(
        F.col("order_no") % 6 == 0, F.array(F.col("file_number"), second)
    ).otherwise(F.array("file_number"))
    amended = F.col("file_type").endswith("/A")
    hit = F.struct(
        F.concat_ws(
            ":", "accession_number", F.substring_index("primary_document", "/", -1)
        ).alias("_id"),
        F.struct(
            F.array(F.lit("0000000001"), F.col("cik")).alias("ciks"),
            numbers.alias("file_num"),
            F.lit("").alias("xsl"),
            F.col("filing_date").alias("file_date"),
            F.when(amended, F.lit("")).otherwise(F.col("file_type")).alias("form"),
            "root_form",
            "file_type",
        ).alias("_source"),
    )
    pages = base.groupBy(F.expr(f"order_no div {PAGE_RANGE}").alias("page")).agg(
        F.collect_list(hit).alias("hits")
    )
    found = F.struct(
        F.struct("hits").alias("hits"), F.struct(F.size("hits").alias("size")).alias("query")
    )
    reason = F.concat(F.lit("no access: "), F.col("c_name")).alias("reason")
    causes = F.array(F.struct(reason)).alias("root_cause")
    failed = F.struct(F.struct(causes).alias("error"))
    customers = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    return pages.select(F.to_json(found).alias("v")).unionAll(
        customers.select(F.to_json(failed).alias("v"))
    )


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_rows(catalog(spark, sf_dir))


def index_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = index(spark, sf_dir)
    return rows.unionAll(rows.where(F.col("cik").endswith("0")))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored files, with gaps."""
    folder = F.substring_index(F.substring_index("file_path", "/", -2), "/", 1)
    number = F.substring(folder, -4, 4).cast("int")
    return index(spark, sf_dir).where(number % 11 != 0).select("file_path")


def index_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index with accession numbers that hold the year of filing, as real ones do."""
    number = F.concat(
        "cik", F.date_format("filing_date", "yy"), F.substring("accession_number", -6, 6)
    )
    return index_rows(catalog(spark, sf_dir).withColumn("accession_number", number))


def order_in_path() -> Column:
    """The last six digits of a path's accession number."""
    folder = F.substring_index(F.substring_index("file_path", "/", -2), "/", 1)
    return F.substring(folder, -6, 6).cast("int")


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two listings of the stored files: some were added, some removed, some changed."""
    number = order_in_path()
    files = index_by_year(spark, sf_dir).select(
        "file_path", (1000 + number % 700).cast("bigint").alias("length"),
        F.col("filing_date").cast("timestamp").alias("modified"), number.alias("n"),
    )
    longer = F.when(F.col("n") % 13 == 0, F.col("length") + 1).otherwise(F.col("length"))
    later = F.when(F.col("n") % 19 == 0, F.col("modified") + F.expr("interval 1 day"))
    changed = {"length": longer, "modified": F.coalesce(later, "modified")}
    old = files.where("n % 17 <> 0").drop("n")
    return old, files.where("n % 11 <> 0").withColumns(changed).drop("n")


def ticker_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON maps of numbered ticker records ``v``; tickers repeat."""
    record = F.struct(
        F.col("s_suppkey").alias("cik_str"),
        F.concat(F.lit("T"), (F.col("s_suppkey") % 60).cast("string")).alias("ticker"),
    )
    entry = F.struct(F.col("s_suppkey").cast("string").alias("key"), record.alias("value"))
    grouped = (
        table(spark, sf_dir, "supplier")
        .groupBy(F.expr(f"s_suppkey div {TICKER_RANGE}").alias("page"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("records"))
    )
    return grouped.select(F.to_json("records").alias("v"))


def exchange_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON headers and rows ``v``; the order of the columns changes between documents."""
    key = F.col("s_suppkey")
    cells = {
        "cik": key.cast("string"),
        "name": F.col("s_name"),
        "ticker": F.concat(F.lit("T"), key.cast("string")),
        "exchange": F.when(key % 3 == 0, "Nasdaq").when(key % 3 == 1, "NYSE").otherwise("OTC"),
    }
    page = F.expr(f"s_suppkey div {TICKER_RANGE // 20}")
    names = list(cells)
    turned = names[::-1]
    row = F.when(page % 2 == 0, F.array(*[cells[name] for name in names])).otherwise(
        F.array(*[cells[name] for name in turned])
    )
    rows = table(spark, sf_dir, "supplier").select(page.alias("page"), row.alias("row"))
    grouped = rows.groupBy("page").agg(F.collect_list("row").alias("data"))
    header = F.when(F.col("page") % 2 == 0, F.array(*[F.lit(n) for n in names])).otherwise(
        F.array(*[F.lit(n) for n in turned])
    )
    return grouped.select(F.to_json(F.struct(header.alias("fields"), "data")).alias("v"))


def company_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users ask for: lower-case tickers, some unknown, and numeric keys."""
    key = F.col("c_custkey")
    asked = F.when(key % 2 == 0, F.concat(F.lit("t"), (key % 70).cast("string"))).otherwise(
        key.cast("string")
    )
    return table(spark, sf_dir, "customer").select(key.alias("q_id"), asked.alias("ticker_or_cik"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieval requests of all companies that ask, half of them with a date range."""
    dated = F.col("q_id") % 4 >= 2
    return company_queries(spark, sf_dir).select(
        "ticker_or_cik",
        F.when(F.col("q_id") % 3 == 0, "10-Q").otherwise("10-K").alias("form_type"),
        F.when(dated, F.lit("1996-01-01")).cast("date").alias("after_date"),
        F.when(dated, F.lit("1999-12-31")).cast("date").alias("before_date"),
    )


def available(plan: DataFrame) -> DataFrame:
    """Addresses that exist: both of each plan row, but for every eleventh accession."""
    number = F.substring("accession_number", -4, 4).cast("int")
    urls = F.explode(F.array("file_url", "fallback_url")).alias("url")
    # Every seventh archive is missing as well, though the main file is there.
    exists = (number % 11 != 0) & ~(F.col("url").endswith(".zip") & (number % 7 == 0))
    return plan.select("accession_number", urls).where(exists).select("url")


def fact_documents(spark: SparkSession, sf_dir: str, share: float = 1.0) -> DataFrame:
    """JSON company-facts documents ``v``, one per line item, company = supplier; about a
    ``share`` of them, where only an impression of them is needed."""
    items = table(spark, sf_dir, "lineitem")
    items = items.sample(share, seed=0) if share < 1 else items

    def text(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))

    # What all facts of a line have in common is written once; a null leaves its field out.
    rest = F.concat_ws(
        ",",
        text("end", F.col("l_shipdate").cast("date").cast("string")),
        text("accn", padded(F.col("l_orderkey"), 18)),
        F.concat(F.lit('"fy":'), F.year("l_shipdate").cast("string")),
        text("fp", F.concat(F.lit("Q"), F.quarter("l_shipdate").cast("string"))),
        text("form", F.when(F.col("l_returnflag") == "R", "10-K").otherwise("10-Q")),
    )
    company = F.concat(F.lit('"cik":'), F.col("l_suppkey").cast("string"), F.lit(","))
    numbers = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    items = spread(items).select(
        *numbers, rest.alias("rest"), F.coalesce(company, F.lit("")).alias("company")
    )

    def facts(*values: Column) -> Column:
        parts = []
        for value in values:
            odd = F.isnan(value) | (F.abs(value) == float("inf"))
            number = F.when(odd, F.concat(F.lit('"'), value.cast("string"), F.lit('"'))).otherwise(value.cast("string"))
            val = F.coalesce(F.concat(F.lit('"val":'), number, F.lit(",")), F.lit(""))
            parts += [F.lit(",{" if parts else "[{"), val, F.col("rest"), F.lit("}")]
        return F.concat(*parts, F.lit("]"))

    price, quantity, discount, tax = (F.col(name) for name in numbers)
    doc = F.concat(
        F.lit("{"), F.col("company"), F.lit('"facts":{"us-gaap":{"Revenues":{"units":{"USD":'),
        facts(price, price * 2),
        F.lit('}},"UnitsSold":{"units":{"shares":'), facts(quantity),
        F.lit('}}},"dei":{"Rates":{"units":{"pure":'), facts(discount), F.lit(',"USD":'), facts(tax),
        # Numbers of more digits than a money amount has, and very small ones.
        F.lit('}},"Shares":{"units":{"pure":'), facts(price / 7, quantity / 1e10), F.lit("}}}}}"),
    )
    return items.select(doc.alias("v"))


def security_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ragged extracted tables of 40 rows: five columns, four, or three."""
    key = F.col("p_partkey")
    code = padded(key, 9)
    table_id = F.expr("p_partkey div 40")
    five = F.array(code, F.lit("*"), F.col("p_brand"), F.col("p_type"), F.lit("ADDED"))
    four = F.array(code, F.col("p_brand"), F.col("p_type"), F.lit(""))
    cells = (
        # The status of some rows is missing: the table is still five wide.
        F.when((table_id % 3 == 0) & (key % 10 == 7), F.slice(five, 1, 4))
        .when(table_id % 3 == 0, five)
        .when(table_id % 3 == 1, four)
        .otherwise(F.slice(four, 1, 3))
    )
    return table(spark, sf_dir, "part").select(
        table_id.alias("table_id"), (key % 40).alias("row_no"), cells.alias("cells")
    )


def file_number_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON maps ``v`` of file numbers to entries, per range of orders."""
    entry = F.array("form_type", "file_path", F.col("filing_date").cast("string"))
    order = F.substring_index(F.substring_index("file_path", "/", -2), "/", 1).cast("bigint")
    number = (
        index(spark, sf_dir)
        .withColumn("page", F.floor(order / PAGE_RANGE))
        .groupBy("page", "file_number")
        .agg(F.collect_list(entry).alias("entries"))
    )
    grouped = number.groupBy("page").agg(
        F.map_from_entries(F.collect_list(F.struct("file_number", "entries"))).alias("numbers")
    )
    return grouped.select(F.to_json("numbers").alias("v"))


def zipped_pages(
    spark: SparkSession, sf_dir: str, folder: str, of_three: int | None = None
) -> DataFrame:
    """One archive per range of pages, below ``folder``: of each page a folder entry, its
    HTML and its address. Column ``archive``. ``of_three``: one of three parts of them."""

    def pack(key, pages):
        system, root = locate(folder)
        system.create_dir(root, recursive=True)
        name = f"{key[0].as_py()}.zip"
        passing = f"{root}/{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(passing) as data:
            with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
                for page in sorted(pages.to_pylist(), key=lambda p: p["page_id"]):
                    place = str(page["page_id"])
                    archive.writestr(f"{place}/", b"")
                    archive.writestr(f"{place}/main.htm", page["html"])
                    archive.writestr(f"{place}/url.txt", page["url"], zipfile.ZIP_STORED)
        system.move(passing, f"{root}/{name}")
        return pa.table({"archive": [f"{folder}/{name}"]})

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    grouped = pages.withColumn("n", F.expr(f"page_id div {ARCHIVE_PAGES}")).groupBy("n")
    if of_three is not None:
        grouped = pages.withColumn("n", F.expr(f"page_id div {ARCHIVE_PAGES}"))
        grouped = grouped.where(F.col("n") % 3 == of_three).groupBy("n")
    written = f"{folder}/names-{of_three}"
    grouped.applyInArrow(pack, "archive string").write.parquet(written)
    return spark.read.parquet(written)


def zipped_submissions(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Archives of submission documents, written by the tasks below ``folder``.

    Every attempt writes files of its own and names only those.
    """

    def pack(batches):
        for batch in batches:
            rows = batch.to_pylist()
            if not rows:
                continue
            system, root = locate(folder)
            system.create_dir(root, recursive=True)
            name = f"{uuid.uuid4().hex}.zip"
            with system.open_output_stream(f"{root}/{name}") as data:
                with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
                    for row in rows:
                        member = f"CIK{row['cik']}-submissions-{row['page']:03d}.json"
                        archive.writestr(member, row["v"])
            paths = pa.array([f"{folder}/{name}"], pa.string())
            yield pa.RecordBatch.from_arrays([paths], ["archive"])

    return submission_documents(spark, sf_dir).mapInArrow(pack, "archive string")


def blank_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog as documents often are: every thirteenth filing has a blank number."""
    blank = F.col("accession_number").cast("bigint") % 13 == 5
    rows = catalog(spark, sf_dir)
    return rows.withColumn("file_num", F.when(blank, F.array(F.lit(""))).otherwise(F.col("file_num")))


def landed(rows: DataFrame) -> DataFrame:
    """``url, content`` of the addresses in ``fetched_url``: small pages with a link to
    another file of the filing, and other files."""
    urls = rows.where("fetched_url is not null").select(F.col("fetched_url").alias("url")).distinct()
    page = F.concat(F.lit('<p>'), "url", F.lit('</p><a href="ex1.htm">exhibit</a>'))
    return urls.select("url", F.encode(page, "UTF-8").alias("content"))
