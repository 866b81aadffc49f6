import os

from pyspark.sql import functions as F

from sluice.streaming.logs import parse_log_lines, read_parsed_logs, run_log_stream

LINES = [
    "2015-10-17 18:14:59,542 INFO [main] org.apache.hadoop.mapred.MapTask: (BUFFER) at 7 used 4096(8192)",
    "2015-10-17 18:15:00,011 WARN [main] org.apache.hadoop.hdfs.LeaseRenewer: Failed to renew lease for "
    "[DFSClient_1] for 30 seconds.  Will retry shortly ...",
    "java.net.ConnectException: Connection refused",
    "\tat sun.nio.ch.SocketChannelImpl.checkConnect(Native Method)",
    "2015-10-17 18:15:01,100 INFO [main] org.apache.hadoop.mapred.Task:  Using ProcessTree : [ ]",
]


def _lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_parse_default(spark):
    rows = parse_log_lines(_lines(spark)).collect()
    assert len(rows) == 3
    r0, r1, r2 = rows
    assert r0.timestamp == "2015-10-17 18:14:59,542"
    assert (r0.status, r0.process, r0.action) == ("INFO", "main", "org.apache.hadoop.mapred.MapTask")
    assert r0.description == "(BUFFER) at 7 used 4096(8192)"
    assert r1.status == "WARN" and r1.action == "org.apache.hadoop.hdfs.LeaseRenewer"
    assert r1.description.startswith("Failed to renew lease")
    assert r2.description == " Using ProcessTree : [ ]"


def test_parse_legacy_pattern(spark):
    rows = parse_log_lines(_lines(spark), legacy=True).collect()
    # The old pattern needs a word character right after ": ".
    assert rows[0].description is None
    assert rows[1].description.startswith("Failed to renew lease")
    assert rows[2].description is None


def test_unparsed_lines_kept_on_request(spark):
    rows = parse_log_lines(_lines(spark), keep_unparsed=True).collect()
    assert len(rows) == 5
    assert rows[2].timestamp is None and rows[3].timestamp is None


def test_crlf_lines_parse_like_lf(spark, tmp_dir):
    path = os.path.join(tmp_dir, "crlf.log")
    with open(path, "w", newline="") as f:
        f.write("\r\n".join(LINES) + "\r\n")
    rows = parse_log_lines(spark.read.text(path)).collect()
    assert len(rows) == 3
    assert rows[0].description == "(BUFFER) at 7 used 4096(8192)"


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    in_dir = os.path.join(tmp_dir, "in")
    os.makedirs(in_dir)
    for i in range(3):
        with open(os.path.join(in_dir, f"part{i}.log"), "w") as f:
            f.write("\n".join(LINES) + "\n")
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    run_log_stream(spark, in_dir, out, ckpt, max_files_per_trigger=1)
    first = read_parsed_logs(spark, out)
    batch = parse_log_lines(spark.read.text(in_dir))
    assert sorted(first.collect()) == sorted(batch.collect())
    assert first.count() == 9
    # Restart on the same checkpoint: no new files, no new rows.
    run_log_stream(spark, in_dir, out, ckpt, max_files_per_trigger=1)
    assert read_parsed_logs(spark, out).count() == 9
    # A new file arrives: only it is processed.
    with open(os.path.join(in_dir, "part9.log"), "w") as f:
        f.write(LINES[0] + "\n")
    run_log_stream(spark, in_dir, out, ckpt)
    assert read_parsed_logs(spark, out).count() == 10
    assert read_parsed_logs(spark, out).where(F.col("status") == "WARN").count() == 3


def test_batches_follow_arriving_files(spark, tmp_dir):
    # 28 files, then one new file per restart: batch 0 reads 28 files, batches 1-3 one each.
    in_dir = os.path.join(tmp_dir, "in")
    os.makedirs(in_dir)

    def put(i):
        with open(os.path.join(in_dir, f"container_{i:02d}.log"), "w") as f:
            f.write(LINES[0] + "\n" + LINES[2] + "\n")

    for i in range(28):
        put(i)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    q = run_log_stream(spark, in_dir, out, ckpt)
    assert (q.lastProgress["batchId"], q.lastProgress["numInputRows"]) == (0, 56)
    for batch in (1, 2, 3):
        put(27 + batch)
        q = run_log_stream(spark, in_dir, out, ckpt)
        assert (q.lastProgress["batchId"], q.lastProgress["numInputRows"]) == (batch, 2)
    assert read_parsed_logs(spark, out).count() == 31


# Lines and the fields they hold, written out by hand: timestamp, status, process, action, description.
EXPECTED = [
    ("2015-10-17 18:14:59,542 INFO [main] org.A: done", ("2015-10-17 18:14:59,542", "INFO", "main", "org.A", "done")),
    ("2015-10-17 18:14:59,542 WARN [IPC Server handler 3 on 80] org.B: a: b: c",
     ("2015-10-17 18:14:59,542", "WARN", "IPC Server handler 3 on 80", "org.B", "a: b: c")),
    ("2015-10-17 18:14:59,542 INFO [main] org.A:nospace: tail", ("2015-10-17 18:14:59,542", "INFO", "main", "org.A", "nospace: tail")),
    ("2015-10-17 18:14:59,542 INFO [main] org.A:  two blanks", ("2015-10-17 18:14:59,542", "INFO", "main", "org.A", " two blanks")),
    ("2015-10-17 18:14:59,542 INFO [main] org.A:", ("2015-10-17 18:14:59,542", "INFO", "main", "org.A", None)),
    ("2015-10-17 18:14:59,542 INFO [main] no action here", ("2015-10-17 18:14:59,542", "INFO", "main", None, None)),
    ("2015-10-17 18:14:59,542 INFO bare", ("2015-10-17 18:14:59,542", "INFO", None, None, None)),
    ("2015-10-17 18:14:59 ERROR [x] T: [y] z", ("2015-10-17 18:14:59", "ERROR", "x", "T", "[y] z")),
    ("\tat org.A.run(A.java:7)", None),
    ("", None),
    ("2015-10-17 no time", None),
]


def test_fields_written_out_by_hand(spark):
    got = parse_log_lines(spark.createDataFrame([(x,) for x, _ in EXPECTED], "value string"), keep_unparsed=True).collect()
    assert len(got) == len(EXPECTED)
    for (line, want), row in zip(EXPECTED, got, strict=True):
        assert (row.timestamp is None) if want is None else (tuple(row) == want), line
    kept = parse_log_lines(spark.createDataFrame([(x,) for x, _ in EXPECTED], "value string")).count()
    assert kept == sum(want is not None for _, want in EXPECTED)
