"""Raw export parsing: every row is either typed or rejected with a reason."""

from leadscope.sources import exports
from tests.conftest import as_parquet

GOOD = '"1",s,"42","2013-05-10","7","3",x,"9",a,b,c,d,1.5,n/a,e,"1",f,"pizza hut"'


def _activity(spark, scratch, rows):
    lines = as_parquet(spark, rows, "id int, line string", scratch)
    return {r.id: r for r in exports.parse_activity_lines(lines).collect()}


def test_activity_good_and_rejected_rows(spark, scratch):
    rows = [
        (1, GOOD),
        (2, "x,y,42"),                                             # short
        (3, GOOD.replace('"42"', '"k42"')),                       # bad key
        (4, GOOD.replace(',"1",f,', ',"0",f,')),                  # not mobile
        (5, GOOD.replace(',"1",f,', ',"2",f,')),                  # any number other than 1: false
        (6, GOOD.replace(',"1",f,', ',"yes",f,')),                # flag must be a number
        (7, GOOD.rsplit(",", 1)[0] + ","),                        # empty last keyword is a valid row
        (8, GOOD.replace('"pizza hut"', '"pizza, hut"')),         # quoted comma splits the field
        (9, None),
        (10, GOOD.replace('"pizza hut"', '\t"pizza hut" ')),      # cleaned
    ]
    got = _activity(spark, scratch, rows)
    r = got[1]
    assert (r.account_key, r.keywords, r.date_text, r.heading_id, r.directory_id, r.referer_id) == \
        (42, "pizza hut", "2013-05-10", 7, 3, 9)
    assert (r.impression_weight, r.click_weight, r.is_mobile, r.reject_reason) == (1.5, 0.0, True, None)
    assert got[2].reject_reason == "short_row"
    assert got[3].reject_reason == "bad_number"
    assert got[4].is_mobile is False and got[4].reject_reason is None
    assert got[5].is_mobile is False and got[5].reject_reason is None
    assert got[6].reject_reason == "bad_number"
    assert got[7].reject_reason is None and got[7].keywords == ""
    assert got[8].reject_reason is None and got[8].keywords == "pizza"
    assert got[9].reject_reason == "short_row"
    assert got[10].keywords == "pizza hut"


def test_good_and_rejects_partition_the_input(spark, scratch):
    rows = [(1, GOOD), (2, "x,y,42"), (3, GOOD.replace('"42"', '"k42"'))]
    parsed = exports.parse_activity_lines(as_parquet(spark, rows, "id int, line string", scratch))
    assert sorted(r.id for r in exports.good(parsed).collect()) == [1]
    assert sorted((r.id, r.reason) for r in exports.rejects(parsed, "id").collect()) == \
        [(2, "short_row"), (3, "bad_number")]


def test_account_verticals(spark, scratch):
    rows = [
        (1, "1;x;A1;Pizza Hut;MERCHANT"),
        (2, '2;x;A2;Tim;""'),          # quoted empty vertical
        (3, "3;x;A3;Tim;"),            # trailing empty vertical (kept; five fields in Spark)
        (4, '"4";x;A4;Tim; client '),  # quoted key is cleaned; vertical trimmed and upper-cased
        (5, "5;x;A5;Tim;AGENCY"),
        (6, "k6;x;A6;Tim;MERCHANT"),
        (7, "7;x"),
        (8, '8;x;A8;Tim;" client "'),  # quotes removed after the trim: ' CLIENT ' is another vertical
    ]
    parsed = exports.parse_account_lines(as_parquet(spark, rows, "id int, line string", scratch))
    got = {r.id: r for r in parsed.collect()}
    assert [i for i, r in sorted(got.items()) if r.reject_reason is None] == [1, 2, 3, 4]
    assert got[4].account_key == 4 and got[4].vertical == "CLIENT"
    assert got[1].account_id == "A1" and got[1].account_name == "Pizza Hut"
    assert (got[5].reject_reason, got[6].reject_reason, got[7].reject_reason, got[8].reject_reason) == \
        ("other_vertical", "bad_number", "short_row", "other_vertical")


def test_extract_positions(spark, scratch):
    line = '"7";m;m;m;m;"12";m;m;m;m;m;m;"3.5";n/a'
    parsed = exports.parse_extract_lines(as_parquet(spark, [(1, line), (2, "x;7")], "id int, line string", scratch))
    got = {r.id: r for r in parsed.collect()}
    assert (got[1].account_key, got[1].directory_id, got[1].impressions, got[1].clicks) == (7, 12, "3.5", "n/a")
    assert got[2].reject_reason == "short_row"


def test_channel_and_day_of_file(spark, scratch):
    from pyspark.sql import functions as F

    rows = [(1, "hdfs://x/source/deduped-2013-05-31.csv.gz"), (2, "/s/API_DTA_D_2013-05-01.csv"), (3, "/s/other.csv")]
    df = as_parquet(spark, rows, "id int, path string", scratch)
    got = {r.id: (r.c, r.d and r.d.isoformat()) for r in df.select(
        "id", exports.channel_of_file(F.col("path")).alias("c"), exports.day_of_file(F.col("path")).alias("d")).collect()}
    assert got == {1: ("online", "2013-05-31"), 2: ("mobile", "2013-05-01"), 3: (None, None)}


def test_read_lines_from_compressed_text(spark, scratch):
    import gzip
    import os

    path = os.path.join(scratch, "deduped-2013-05-02.csv.gz")
    with gzip.open(path, "wt") as fh:
        fh.write(GOOD + "\nx,y\n")
    parsed = exports.parse_activity_lines(exports.read_lines(spark, path))
    assert sorted(r.reject_reason or "" for r in parsed.collect()) == ["", "short_row"]
    assert parsed.select("source_file").first()[0].endswith("deduped-2013-05-02.csv.gz")


def test_quoted_option_keeps_commas_inside_quotes(spark, scratch):
    line = GOOD.replace('"pizza hut"', '"pizza, hut"')
    lines = as_parquet(spark, [(1, line), (2, GOOD)], "id int, line string", scratch)
    positional = {r.id: r.keywords for r in exports.parse_activity_lines(lines).collect()}
    quoted = {r.id: r.keywords for r in exports.parse_activity_lines(lines, quoted=True).collect()}
    assert positional == {1: "pizza", 2: "pizza hut"}
    assert quoted == {1: "pizza, hut", 2: "pizza hut"}


def test_quoted_option_on_long_and_unpaired_lines(spark, scratch):
    long = GOOD.replace('"pizza hut"', '"pizza, hut"') + ',"a,b"' * 10_000
    got = {r.id: r for r in exports.parse_activity_lines(
        as_parquet(spark, [(1, long), (3, None), (4, "")], "id int, line string", scratch), quoted=True).collect()}
    assert got[1].keywords == "pizza, hut" and got[1].reject_reason is None
    assert got[3].reject_reason == got[4].reject_reason == "short_row"


def test_split_quoted_against_a_count_of_quotes(spark, scratch):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    lines = ["".join(rng.choice('ab",," ') for _ in range(rng.randint(0, 25))) for _ in range(500)]

    def fields(line):
        out, at = [], 0
        for i, c in enumerate(line):
            if c == "," and line[i:].count('"') % 2 == 0:
                out.append(line[at:i])
                at = i + 1
        return [*out, line[at:]]

    df = as_parquet(spark, [(x,) for x in lines], "line string", scratch)
    for r in df.select("line", exports.split_quoted(F.col("line"), ",").alias("f")).collect():
        assert r.f == fields(r.line)


def _scans(df):
    """(files, rows) of every scan in the plan that ran."""
    df.collect()

    def walk(p, out):
        name = p.nodeName()
        if "Scan" in name:
            out.append((p.metrics().apply("numFiles").value(), p.metrics().apply("numOutputRows").value()))
        inner = [p.executedPlan()] if name.startswith("AdaptiveSparkPlan") else [p.plan()] if "QueryStage" in name else []
        children = p.children().iterator()
        while children.hasNext():
            inner.append(children.next())
        for q in inner:
            walk(q, out)
        return out

    return walk(df._jdf.queryExecution().executedPlan(), [])


def test_large_compressed_files_are_dealt_out_before_the_parse(spark, scratch):
    import gzip
    import os

    from pyspark.sql import functions as F

    folder = os.path.join(scratch, "raw")
    os.makedirs(folder)
    lines = [GOOD.replace("pizza hut", f"term {i}") if i % 10 else "x,y" for i in range(5_000)] + [GOOD] * 5_000
    for name, body in (("deduped-2013-05-02.csv.gz", lines), ("deduped-2013-05-03.csv.gz", lines[:20])):
        with gzip.open(os.path.join(folder, name), "wt") as fh:
            fh.write("\n".join(body) + "\n")
    with open(os.path.join(folder, "deduped-2013-05-04.csv"), "w") as fh:
        fh.write("\n".join(lines[:3_000]) + "\n")

    read = exports.read_lines(spark, folder, whole_bytes=2_000, parts=8)
    assert sorted(_scans(read)) == [(1, 10_000), (2, 3_020)]                   # every file is read once
    parsed = exports.parse_activity_lines(read)
    plain = exports.parse_activity_lines(exports.read_lines(spark, folder))
    assert parsed.exceptAll(plain).isEmpty() and plain.exceptAll(parsed).isEmpty()
    assert exports.rejects(parsed).count() == 500 + 2 + 300
    big = parsed.where(F.col("source_file").contains("05-02"))
    tasks = [r["count"] for r in big.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == 8 and max(tasks) < 2_000                              # repeated lines are spread as well
    others = parsed.where(~F.col("source_file").contains("05-02")).groupBy("source_file", F.spark_partition_id()).count()
    assert others.count() == 2                                                 # small and plain files stay where they are
