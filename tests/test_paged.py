"""Paged searches as a data source, with a transport that counts what it is asked."""

import pytest

from quillspark.sources import paged

FIELDS = {"serial": "id", "title": "name"}
TOTALS = {"many": 23, "ten": 10, "none": 0, "é & <x>": 3}


def transport(log, broken=()):
    def fetch(keyword, page):
        with open(log, "a", encoding="utf-8") as f:
            f.write(f"{keyword} {page}\n")
        if (keyword, page) in broken:
            raise ConnectionError("gone")
        n = TOTALS[keyword]
        items = "".join(f"<prec><id>{i}</id><name>t<b>{i}</b></name></prec>" for i in range((page - 1) * 5, min(page * 5, n)))
        return f"<r><totalCnt>{n}</totalCnt>{items}</r>"

    return fetch


def asked(log):
    return sorted(open(log, encoding="utf-8").read().splitlines()) if log.exists() else []


def test_all_pages_are_read(spark, tmp_path):
    df = paged.search_pages(spark, [*TOTALS, "ten"], transport(str(tmp_path / "log")), FIELDS, page_rows=5)
    assert df.columns == ["keyword", "page", "pos", "serial", "title"] and df.rdd.getNumPartitions() == 5 + 2 + 1
    got = sorted(map(tuple, df.collect()))
    assert got == sorted((k, i // 5 + 1, i % 5, str(i), f"t{i}") for k, n in TOTALS.items() for i in range(n))
    assert paged.search_pages(spark, [], transport(str(tmp_path / "log")), FIELDS).count() == 0


def test_a_failed_page_is_asked_again_alone(spark, tmp_path):
    store, log = str(tmp_path / "store"), tmp_path / "log"
    with pytest.raises(Exception, match="gone"):
        paged.search_pages(spark, list(TOTALS), transport(str(log), {("many", 3)}), FIELDS, store, page_rows=5).collect()
    first = asked(log)
    assert "many 3" in first
    log.unlink()
    df = paged.search_pages(spark, list(TOTALS), transport(str(log)), FIELDS, store, page_rows=5)
    assert df.count() == sum(TOTALS.values())
    again = asked(log)
    assert "many 3" in again and not set(again) & (set(first) - {"many 3"})
    log.unlink()
    assert df.count() == sum(TOTALS.values()) and asked(log) == []


def test_searches_do_not_end_silently(spark):
    for answer, what in (("<r>", "no XML"), ("<r/>", "how many"), ("<r><totalCnt>7</totalCnt><prec/></r>", "has 1 items, not")):
        with pytest.raises(Exception, match=what):
            paged.search_pages(spark, ["k"], lambda k, p, a=answer: a, FIELDS, page_rows=5).collect()
