"""Transaction scripts: text files of client requests.

Record layout, one per line, comma separated (first field = type code):
  N,c_id,w_id,d_id,M   followed by M lines  i_id,supply_w_id,quantity
  P,w_id,d_id,c_id,amount      D,w_id,carrier_id     O,w_id,d_id,c_id
  S,w_id,d_id,T,L              I,w_id,d_id,L         T     R,w_id,d_id,c_id

Parsing is distributed: files are split by the text reader as usual and the
order of lines inside a file is kept as (split start, row position); line
numbers and the header each New-Order item line belongs to are carried
across splits through small per-split totals, so no file is held by one
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import Window as W

# Type codes and the minimum number of fields of each record.
MIN_FIELDS = {"N": 5, "P": 5, "D": 3, "O": 4, "S": 5, "I": 4, "T": 1, "R": 4}
ITEM_FIELDS = 3


def _record(df, client, k1, code, text):
    return df.select(client.cast("int").alias("client"), k1.cast("long").alias("k1"),
                     F.lit(code).alias("k2"), F.lit(0).cast("long").alias("k3"), text.alias("text"))


def _order_records(t) -> list[DataFrame]:
    """New-Order records and their item lines."""
    s = F.col
    lines = t.new_order_line_requests
    m = lines.groupBy("seq").agg(F.count(F.lit(1)).alias("m"))
    heads = t.new_order_requests.join(m, "seq", "left").withColumn("m", F.coalesce("m", F.lit(0)))
    return [_record(heads, s("seq") % 20, s("seq"), "N", F.concat_ws(",", F.lit("N"), s("c_id"), s("w_id"), s("d_id"), s("m"))),
            lines.join(t.new_order_requests.select("seq"), "seq").select(
                (s("seq") % 20).cast("int").alias("client"), s("seq").cast("long").alias("k1"),
                F.lit("N").alias("k2"), s("line_no").cast("long").alias("k3"),
                F.concat_ws(",", s("i_id"), s("supply_w_id"), s("quantity")).alias("text"))]


def _payment_records(t) -> DataFrame:
    s = F.col
    return _record(t.payment_requests, s("seq") % 20, s("seq"), "P",
                   F.concat_ws(",", F.lit("P"), s("w_id"), s("d_id"), s("c_id"), s("amount").cast("string")))


def busy_lines(t) -> DataFrame:
    """Scripts of new orders, payments and many deliveries (a click of a customer asks for one in
    its warehouse), as they come in turn: districts run empty between new orders."""
    s = F.col
    e = t.raw("events").filter(s("event_type") == "click")
    c = t.customers.select("c_id", "c_w_id")
    clicks = e.join(c, e.user_id == c.c_id).select(s("event_id").alias("seq"), s("c_w_id").alias("w_id"), (s("event_id") % 10 + 1).alias("carrier_id"))
    out = _record(clicks, s("seq") % 20, s("seq"), "D", F.concat_ws(",", F.lit("D"), s("w_id"), s("carrier_id")))
    for p in [*_order_records(t), _payment_records(t)]:
        out = out.unionByName(p)
    return out


def script_lines(t) -> DataFrame:
    """The lines of the client scripts derived from the request tables.

    Columns: client, k1, k2, k3 (order inside the client's files), text. Error
    events become faulty records of six kinds, by event number: too short, a
    text for a number, an unknown type, a New-Order with fewer lines than it
    says, an item line without an order, a New-Order with a text for a quantity.
    The parser must reject them all.
    """
    s = F.col
    rec = _record
    parts = [
        *_order_records(t),
        _payment_records(t),
        rec(t.delivery_requests, s("w_id") % 20, s("seq"), "D",
            F.concat_ws(",", F.lit("D"), s("w_id"), s("carrier_id"))),
        rec(t.customer_requests, s("c_id") % 20, s("c_id"), "O",
            F.concat_ws(",", F.lit("O"), s("w_id"), s("d_id"), s("c_id"))),
        rec(t.related_requests, s("c_id") % 20, s("c_id"), "R",
            F.concat_ws(",", F.lit("R"), s("w_id"), s("d_id"), s("c_id"))),
        rec(t.stock_level_requests, (s("w_id") * 10 + s("d_id")) % 20, s("w_id") * 10 + s("d_id"), "S",
            F.concat_ws(",", F.lit("S"), s("w_id"), s("d_id"), s("threshold"), s("last_l"))),
        rec(t.popular_requests, (s("w_id") * 10 + s("d_id")) % 20, s("w_id") * 10 + s("d_id"), "I",
            F.concat_ws(",", F.lit("I"), s("w_id"), s("d_id"), s("last_l"))),
        rec(t.warehouses, s("w_id") % 20, s("w_id"), "T", F.lit("T")),
    ]
    error = t.raw("events").filter(s("event_type") == "error")
    fault = s("event_id") % 6
    texts = (F.when(fault == 0, F.array(F.concat_ws(",", F.lit("P"), s("user_id"))))
             .when(fault == 1, F.array(F.lit("P,1,1,x,5.00")))
             .when(fault == 2, F.array(F.lit("Q,1,2")))
             .when(fault == 3, F.array(F.concat_ws(",", F.lit("N"), s("user_id"), F.lit("1,1,3")), F.lit("1,1,1")))
             .when(fault == 4, F.array(F.lit("1,1,1")))
             .otherwise(F.array(F.concat_ws(",", F.lit("N"), s("user_id"), F.lit("1,1,2")), F.lit("1,1,1"), F.lit("3,1,y"))))
    parts.append(error.select((s("event_id") % 20).cast("int").alias("client"), s("event_id").cast("long").alias("k1"), F.lit("Z").alias("k2"),
                              F.posexplode(texts).alias("k3", "text")).withColumn("k3", s("k3").cast("long")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_scripts(t, out_dir: str, lines: DataFrame | None = None) -> str:
    """Write the client scripts (``client=K/part=P/*.txt``), lines in script
    order; a record and its lines are in one file. Ranges of (client, part, k1) go to tasks
    by sampled bounds, so files and tasks grow with the rows, and a client's files
    in the order of their names hold its lines in order."""
    lines = (script_lines(t) if lines is None else lines).withColumn("part", (F.col("k1") / 20).cast("long") % 2)
    (lines.repartitionByRange("client", "part", "k1").sortWithinPartitions("client", "part", "k1", "k2", "k3")
          .select("client", "part", "text").write.mode("overwrite").partitionBy("client", "part").text(out_dir))
    return out_dir


def name_by_client(spark: SparkSession, script_dir: str, out_dir: str) -> str:
    """Move the files of ``write_scripts`` to ``run-N/<client>.txt``, N in the order of a client's files: the
    form in which clients are started, one numbered file each. Files are renamed, not read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(script_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted(s.getPath().toString() for s in fs.globStatus(path(f"{script_dir}/client=*/part=*/part-*")))
    seen: dict[str, int] = {}
    for f in found:
        client = f.rsplit("client=", 1)[1].split("/")[0]
        n = seen[client] = seen.get(client, -1) + 1
        run = path(f"{out_dir}/run-{n:06d}")
        fs.mkdirs(run)
        if not fs.rename(path(f), path(run, f"{client}.txt")):
            raise OSError(f"can't move {f}")
    return out_dir


def read_script_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with their file, client number and order key inside the file.

    The order of lines in a file is (split start, row position in the
    split): ``monotonically_increasing_id`` increases within a split and is
    taken right at the scan, so it is stable when a task is re-run.
    """
    raw = spark.read.text(path).select(
        F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"))
    return with_client(raw)


def with_client(lines: DataFrame) -> DataFrame:
    """Add the client: the number in a ``client=K`` folder, else the file's stem
    (``7.txt``); null where neither is a number."""
    folder = F.regexp_extract("file", r"client=(\d+)/", 1)
    stem = F.regexp_extract("file", r"([^/]*?)(\.[^/.]*)?$", 1)
    return lines.withColumn("client", F.when(folder != "", folder).otherwise(stem).try_cast("int"))


def _fields(c):
    return F.transform(F.split(c, ","), lambda x: F.trim(x))


def parse_scripts(lines: DataFrame) -> DataFrame:
    """Number every line of a file and carry its header forward.

    One row per non-blank line with: file, client, line_no, kind ('header'
    or 'item'), code, fields, header_line, header_code, header_m (the item
    count M of a New-Order header) and item_idx (position after the header).

    Plan (no file is held by one task): each split is numbered by a window
    over (file, split); the same window carries the last header, as a struct
    (position, code, M), forward inside the split; one small aggregate per
    split gives its line count and last header; a window over those rows
    gives every split its line offset and the header open at its start; a
    join on (file, split) puts it together.
    """
    f = _fields(F.col("text"))
    code = F.upper(f[0])
    d = lines.filter(F.trim("text") != "").select(
        "file", "block", "pos", "client", f.alias("fields"),
        F.when(code.rlike("^[A-Z]$"), code).alias("code"))
    m = F.when(F.col("code") == "N", F.try_element_at("fields", F.lit(5)).try_cast("int"))
    wl = W.partitionBy("file", "block").orderBy("pos")
    run = W.partitionBy("file", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("__rn", F.row_number().over(wl))
    hdr = F.when(F.col("code").isNotNull(),
                 F.struct(F.col("__rn").cast("long").alias("p"), F.col("code").alias("c"), m.alias("m")))
    d = d.withColumn("__h", hdr).withColumn("__lh", F.max("__h").over(run))

    per = d.groupBy("file", "block").agg(F.count(F.lit(1)).alias("__cnt"), F.max("__h").alias("__last"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("__off", F.coalesce(F.sum("__cnt").over(before), F.lit(0)))
    per = per.withColumn("__glast", F.when(F.col("__last").isNotNull(), F.struct(
        (F.col("__off") + F.col("__last.p")).alias("p"), F.col("__last.c").alias("c"),
        F.col("__last.m").alias("m"))))
    per = per.withColumn("__prev", F.max("__glast").over(before)).select("file", "block", "__off", "__prev")

    j = d.join(per, ["file", "block"], "inner")
    cur = F.when(F.col("__lh").isNotNull(), F.struct(
        (F.col("__off") + F.col("__lh.p")).alias("p"), F.col("__lh.c").alias("c"), F.col("__lh.m").alias("m")))
    j = j.withColumn("__hd", F.coalesce(cur, F.col("__prev")))
    line_no = (F.col("__off") + F.col("__rn")).cast("long")
    return j.select(
        "file", "client", line_no.alias("line_no"), "fields", "code",
        F.when(F.col("code").isNotNull(), "header").otherwise("item").alias("kind"),
        F.col("__hd.p").alias("header_line"), F.col("__hd.c").alias("header_code"),
        F.col("__hd.m").alias("header_m"),
        (line_no - F.col("__hd.p")).alias("item_idx"))


def _int(a, i):
    return F.try_element_at(a, F.lit(i)).try_cast("int")


def _long(a, i):
    return F.try_element_at(a, F.lit(i)).try_cast("long")


def transactions(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid transactions and rejected lines.

    A header is valid when it has enough numeric fields; a New-Order header
    also needs its M item lines right after it (M = 0 is an order without
    lines). An item line needs three numbers; without, it is rejected, and its
    order is incomplete. Item lines beyond M, before any header, or after
    another type of header are orphans. A New-Order header and its item lines share
    (file, header_line), so one grouped aggregate counts the attached
    items; orphans are found line by line.
    """
    placed = ((F.col("kind") == "item") & (F.col("header_code") == "N") & (F.col("item_idx") >= 1)
              & (F.col("item_idx") <= F.col("header_m")))
    numbers = _long(F.col("fields"), 1).isNotNull() & _int(F.col("fields"), 2).isNotNull() & _int(F.col("fields"), 3).isNotNull()
    p = parsed.withColumn("placed", F.coalesce(placed, F.lit(False))).withColumn("attached", F.col("placed") & numbers)
    groups = (p.filter((F.col("kind") == "header") | F.col("attached"))
               .groupBy("file", "header_line")
               .agg(F.min("client").alias("client"),
                    F.first(F.when(F.col("kind") == "header", F.col("fields")), ignorenulls=True).alias("fields"),
                    F.first(F.when(F.col("kind") == "header", F.col("code")), ignorenulls=True).alias("code"),
                    F.count(F.when(F.col("attached"), 1)).alias("n_found")))
    a = F.col("fields")
    n = F.size(a)
    minf = F.create_map(*[x for k, v in MIN_FIELDS.items() for x in (F.lit(k), F.lit(v))])
    need = F.try_element_at(minf, F.col("code"))
    typed = groups.select(
        "file", "client", F.col("header_line").alias("line_no"), F.col("code").alias("txn_type"), "n_found",
        F.when(F.col("code") == "N", _int(a, 3)).when(F.col("code").isin("T"), F.lit(None))
         .otherwise(_int(a, 2)).alias("w_id"),
        F.when(F.col("code") == "N", _int(a, 4))
         .when(F.col("code").isin("P", "O", "S", "I", "R"), _int(a, 3)).alias("d_id"),
        F.when(F.col("code") == "N", _long(a, 2))
         .when(F.col("code").isin("P", "O", "R"), _long(a, 4)).alias("c_id"),
        F.when(F.col("code") == "P", F.try_element_at(a, F.lit(5)).try_cast("decimal(12,2)")).alias("amount"),
        F.when(F.col("code") == "D", _int(a, 3)).alias("carrier_id"),
        F.when(F.col("code") == "S", _int(a, 4)).alias("threshold"),
        F.when(F.col("code") == "S", _int(a, 5)).when(F.col("code") == "I", _int(a, 4)).alias("last_l"),
        F.when(F.col("code") == "N", _int(a, 5)).alias("n_items"),
        (n >= F.coalesce(need, F.lit(10 ** 6))).alias("arity_ok"),
        need.isNotNull().alias("known"))
    c = F.col
    numeric_ok = (
        F.when(c("txn_type") == "T", True)
         .when(c("txn_type") == "D", c("w_id").isNotNull() & c("carrier_id").isNotNull())
         .when(c("txn_type") == "N", c("w_id").isNotNull() & c("d_id").isNotNull()
               & c("c_id").isNotNull() & (c("n_items") >= 0))
         .when(c("txn_type") == "P", c("w_id").isNotNull() & c("d_id").isNotNull()
               & c("c_id").isNotNull() & c("amount").isNotNull())
         .when(c("txn_type") == "S", c("w_id").isNotNull() & c("d_id").isNotNull()
               & c("threshold").isNotNull() & c("last_l").isNotNull())
         .when(c("txn_type") == "I", c("w_id").isNotNull() & c("d_id").isNotNull() & c("last_l").isNotNull())
         .otherwise(c("w_id").isNotNull() & c("d_id").isNotNull() & c("c_id").isNotNull()))
    ok = c("client").isNotNull() & c("known") & c("arity_ok") & F.coalesce(numeric_ok, F.lit(False))
    complete = (c("txn_type") != "N") | (c("n_found") == c("n_items"))
    cols = ["file", "client", "line_no", "txn_type", "w_id", "d_id", "c_id", "amount", "carrier_id",
            "threshold", "last_l", "n_items"]
    valid = typed.filter(ok & complete).select(*cols)
    reason = (F.when(c("client").isNull(), "unknown_client").when(~c("known"), "unknown_type").when(~c("arity_ok"), "short_record")
               .when(~ok, "bad_number").otherwise("incomplete_order"))
    bad_headers = typed.filter(~(ok & complete)).select("file", "client", "line_no", reason.alias("reason"))
    wrong = F.when(~c("placed"), "orphan_line").when(F.size("fields") < ITEM_FIELDS, "short_record").otherwise("bad_number")
    orphans = p.filter((c("kind") == "item") & ~c("attached")).select("file", "client", "line_no", wrong.alias("reason"))
    return valid, bad_headers.unionByName(orphans)


def new_order_items(parsed: DataFrame) -> DataFrame:
    """Item lines of valid New-Order headers: (file, header_line, line_no,
    i_id, supply_w_id, quantity)."""
    a = F.col("fields")
    return (parsed.filter(F.col("kind") == "item")
                  .select("file", "header_line", F.col("item_idx").alias("line_no"),
                          _long(a, 1).alias("i_id"), _int(a, 2).alias("supply_w_id"),
                          _int(a, 3).alias("quantity")))


def request_tables(valid: DataFrame, parsed: DataFrame) -> dict:
    """Request tables of all eight transaction types found in the scripts.

    ``seq`` orders requests as the clients issued them: by client, then by the
    client's files in the order of their names, then by line
    (client * 2^45 + file number * 2^32 + line number). Entry and delivery times are the
    time of the run, as when the transactions are executed.
    """
    # one row per file
    files = (valid.groupBy("client", "file").agg(F.count(F.lit(1)).alias("n"))
             .select("file", (F.row_number().over(W.partitionBy("client").orderBy("file")) - 1).cast("long").alias("file_no")))
    valid = valid.join(files, "file")
    seq = (F.col("client").cast("long") * F.lit(1 << 45) + F.col("file_no") * F.lit(1 << 32) + F.col("line_no")).alias("seq")
    now = F.localtimestamp()
    pay = valid.filter(F.col("txn_type") == "P").select(seq, "w_id", "d_id", "c_id", "amount")
    heads = valid.filter(F.col("txn_type") == "N")
    new_orders = heads.select(seq, "w_id", "d_id", "c_id", now.alias("entry_d"))
    items = new_order_items(parsed).filter(F.col("line_no") >= 1)
    hk = heads.select("file", F.col("line_no").alias("header_line"), "n_items", seq)
    new_lines = (items.join(hk, ["file", "header_line"], "inner")
                      .filter(F.col("line_no") <= F.col("n_items"))
                      .select("seq", F.col("line_no").cast("int").alias("line_no"), "i_id",
                              "supply_w_id", "quantity"))
    deliveries = valid.filter(F.col("txn_type") == "D").select(seq, "w_id", "carrier_id",
                                                                now.alias("delivery_d"))
    def of(code: str, *cols: str) -> DataFrame:
        return valid.filter(F.col("txn_type") == code).select(seq, "client", *cols)

    return {"payments": pay, "new_orders": new_orders, "new_lines": new_lines, "deliveries": deliveries,
            "order_status": of("O", "w_id", "d_id", "c_id"), "stock_level": of("S", "w_id", "d_id", "threshold", "last_l"),
            "popular_items": of("I", "w_id", "d_id", "last_l"), "top_balance": of("T"),
            "related_customers": of("R", "w_id", "d_id", "c_id")}
