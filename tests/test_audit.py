"""End-to-end audit from files, including the charset fix for digests."""

import hashlib

from keysieve.operators import audit
from keysieve.sources import io, wordlist


def test_audit_latin1_list_matches_utf8_digest(spark, tmp_path):
    wl = tmp_path / "list.txt"
    # "pé" stored as UTF-8 bytes in a list that is read as latin-1, a cp1252
    # style "café" (E9), a blank line, and a plain password twice.
    wl.write_bytes(b"p\xc3\xa9\r\ncaf\xe9\n\n  \npassword\npassword\n")
    corpus = tmp_path / "corpus"
    corpus.mkdir()
    lines = []
    for raw, count in [(b"p\xc3\xa9", 12), (b"password", 3)]:
        h = hashlib.sha1(raw).hexdigest().upper()
        lines.append(f"{h}:{count}")
    (corpus / "all.txt").write_text("\n".join(lines) + "\n")
    out = audit.audit_wordlist(spark, str(wl), str(corpus), str(tmp_path / "out"),
                               charset="ISO-8859-1", keep_plaintext=True)
    rows = {r["password"]: r for r in out.collect()}
    assert set(rows) == {"pÃ©", "café", "password"}
    assert (rows["pÃ©"]["breach_count"], rows["pÃ©"]["exposed"],
            rows["pÃ©"]["common_or_rare"]) == (12, 1, "common")
    assert (rows["password"]["freq"], rows["password"]["breach_count"]) == (2, 3)
    assert rows["café"]["exposed"] == 0
    # plaintext can be dropped from the written table
    out2 = audit.audit_wordlist(spark, str(wl), str(corpus), str(tmp_path / "out2"))
    assert "password" not in out2.columns and out2.count() == 3


def test_audit_hashes_the_lines_own_bytes(spark, tmp_path):
    # Last bytes of these letters are latin-1 white space.
    raw = ["caff\u00e0", "\u043c\u0435\u0445", "password", "p\u00e9", "a password of more than twenty characters"]
    (tmp_path / "l.txt").write_text("\n".join(raw) + "\n", encoding="utf-8")
    (tmp_path / "c.txt").write_text("".join(hashlib.sha1(x.encode()).hexdigest() + ":11\n" for x in raw))
    for charset in ("ISO-8859-1", "UTF-8"):
        out = audit.audit_wordlist(spark, str(tmp_path / "l.txt"), str(tmp_path / "c.txt"),
                                   str(tmp_path / charset), charset=charset)
        assert [(r["exposed"], r["breach_count"]) for r in out.collect()] == [(1, 11)] * 5
    lines = wordlist.read_wordlist(spark, str(tmp_path / "l.txt"))
    assert tuple(audit.removed(lines, 20).first()) == (5, 0, 1)
    assert tuple(audit.removed(lines).first()) == (5, 0, 0)
    assert audit.cleaned(lines, 20).count() == 4


def test_csv_inferred_and_declared(spark, tmp_path):
    p = str(tmp_path / "f")
    df = spark.createDataFrame([("Iceland", 3), ("Peru", 12)], "DEST_COUNTRY_NAME string, count bigint")
    io.write_csv(df, p)
    declared = io.read_csv(spark, p)
    inferred = io.read_csv(spark, p, infer=True)
    assert dict(declared.dtypes)["count"] == "bigint"
    assert dict(inferred.dtypes)["count"] == "int"
    assert sorted(map(tuple, declared.collect())) == [("Iceland", 3), ("Peru", 12)]


def test_audit_resume_reuses_finished_output(spark, tmp_path):
    wl = tmp_path / "l.txt"
    wl.write_bytes(b"password\nabc\n")
    corpus = tmp_path / "c"
    corpus.mkdir()
    (corpus / "x.txt").write_text(hashlib.sha1(b"password").hexdigest().upper() + ":5\n")
    out = str(tmp_path / "out")
    first = audit.audit_wordlist(spark, str(wl), str(corpus), out, keep_plaintext=True, resume=True)
    assert first.count() == 2
    wl.write_bytes(b"changed\n")  # a resumed run must not recompute
    again = audit.audit_wordlist(spark, str(wl), str(corpus), out, keep_plaintext=True, resume=True)
    assert sorted(r["password"] for r in again.collect()) == ["abc", "password"]
