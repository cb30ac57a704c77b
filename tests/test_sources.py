"""Word-list scan and breach range parsing on hand-made files."""

import pytest

from keysieve.sources import breach as breach_src
from keysieve.sources import wordlist


def test_wordlist_latin1_and_line_ends(spark, tmp_path):
    p = tmp_path / "list.txt"
    # café (latin-1 E9), CRLF and lone-CR line ends, surrounding blanks, a blank line
    p.write_bytes(b"caf\xe9\r\n  hello \n\rworld\t\n\xa0x\xa0\n")
    got = [r[0] for r in wordlist.read_wordlist(spark, str(p)).collect()]
    assert "café" in got and "hello" in got and "world" in got and "x" in got
    assert "" in got  # the empty line survives the scan; the blank filter drops it


def test_wordlist_utf8(spark, tmp_path):
    p = tmp_path / "u.txt"
    p.write_bytes("pé\n".encode())
    assert [r[0] for r in wordlist.read_wordlist(spark, str(p), charset="UTF-8").collect()] == ["pé"]


GOOD = "0005AD76BD555C1D6D771DE417A4B87E4B4"


def test_wordlist_keeps_the_bytes(spark, tmp_path):
    p = tmp_path / "b.txt"
    raw = ["caff\u00e0".encode(), "\u043c\u0435\u0445".encode(), b"p\xe9", b"\x85x\xa0", b" \t in \x0b"]
    p.write_bytes(b"\n".join(raw) + b"\n")
    for charset in ("ISO-8859-1", "UTF-8"):
        got = [bytes(r["password_bytes"]) for r in wordlist.read_wordlist(spark, str(p), charset=charset).collect()]
        assert got == [*raw[:4], b"in"]
    utf8 = [r["password"] for r in wordlist.read_wordlist(spark, str(p), charset="UTF-8").collect()]
    assert utf8[:3] == ["caff\u00e0", "\u043c\u0435\u0445", "p\u00e9"]  # a stray byte is read as latin-1
    assert tuple(wordlist.undecodable(spark, str(p)).first()) == (5, 2)


def test_breach_range_files(spark, tmp_path):
    d = tmp_path / "20251"  # a folder that looks like a prefix is none
    d.mkdir()
    (d / "00000").write_bytes(
        (GOOD + ":10\r\n" + GOOD.lower()[:-1] + "f:3\n" + "nocolon\n" + "x:y\n"
         + GOOD + ":abc\n" + GOOD[:-1] + "0:3000000000\n" + GOOD[:-1] + "1:99999999999999999999\n").encode())
    (d / "0a1b2.txt").write_text(GOOD + ":7\n")
    (d / "0A1B3.tar.txt").write_text(GOOD + ":8\n")
    (d / "prefix=FFFFF").mkdir()
    (d / "prefix=FFFFF" / "ABCDE").write_text(GOOD + ":9\n")
    (d / "all.txt").write_text("AAAAA" + GOOD + ":5\n")
    rows = {(r.prefix, r.suffix, r.breach_count)
            for r in breach_src.read_breach_ranges(spark, str(d)).collect()}
    assert rows == {("00000", GOOD, 10), ("00000", GOOD[:-1] + "F", 3), ("00000", GOOD[:-1] + "0", 3000000000),
                    ("0A1B2", GOOD, 7), ("0A1B3", GOOD, 8), ("FFFFF", GOOD, 9), ("AAAAA", GOOD, 5)}
    rej = breach_src.breach_rejects(spark, str(d)).first()
    assert (rej.lines, rej.accepted, rej.rejected) == (11, 7, 4)


def test_suffix_lines_without_a_prefix_stop_the_read(spark, tmp_path):
    (tmp_path / "download.log").write_bytes(b"some log line\n" + (GOOD + ":5\n").encode())
    with pytest.raises(Exception, match="no five-hex prefix"):
        breach_src.read_breach_ranges(spark, str(tmp_path)).collect()
    assert breach_src.read_breach_ranges(spark, str(tmp_path), strict=False).count() == 0
    assert tuple(breach_src.breach_rejects(spark, str(tmp_path)).first()) == (2, 0, 2)


def test_corpus_is_unique_with_large_counts(spark):
    lines = spark.createDataFrame([("ABCDE", "0" * 35, 3_000_000_000), ("ABCDE", "0" * 35, 4), ("00012", "F" * 35, 7)],
                                  "prefix string, suffix string, breach_count bigint")
    c = breach_src.corpus(lines)
    assert c.dtypes == [("digest", "binary"), ("breach_count", "bigint")]
    assert sorted(map(tuple, breach_src.with_range(c).collect())) == [
        ("00012", "F" * 35, 7), ("ABCDE", "0" * 35, 3_000_000_000)]


def test_breach_full_hash_lines(spark, tmp_path):
    df = spark.createDataFrame([(bytearray.fromhex("ABCDE" + "0" * 35), 4)], "digest binary, breach_count bigint")
    out = str(tmp_path / "full")
    breach_src.write_breach_hashes(df, out)
    assert [tuple(r) for r in breach_src.read_breach_ranges(spark, out).collect()] == \
        [("ABCDE", "0" * 35, 4)]


def test_compacted_corpus_is_not_shuffled(spark, tmp_path, sf_dir):
    from keysieve.operators import breach as B
    from keysieve.sources import tables as T
    table = breach_src.compact_breach(T.breach(spark, sf_dir), "compacted_test", str(tmp_path / "compact"), buckets=4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        m = B.match_breach(T.candidates(spark, sf_dir), table)
        plan = m._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(_digest_key") == 1 and "Bucketed: true" in plan
        assert m.count() == B.match_breach(T.candidates(spark, sf_dir), T.breach(spark, sf_dir)).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE compacted_test")
