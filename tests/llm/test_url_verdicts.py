"""Verdicts of urls without a rule: planted hosts, at two sizes of the table."""

import pytest

from conftest import FOLDER
from factloom.llm import url_filter

#: Hosts of no rule.  The rules block most of the pages they decide, all but one of /en/.
CLEAN = ["garden.example.org/en/1", "news.example.net/en/2", "garden.example.org/fr/3", "lake.org/en/4"]
BAD = ["free-casino.example.org/en/1", "porn.example.net/en/2", "spam.org/fr/3", "bet-poker.org/de/4"]
DECIDED = ["garden.com/de/8", "news.com/fr/9", "garden.com/es/4", "news.com/de/2", "www.example.com/en/7"]
DECIDED += [f"{w}.example.com/en/{i}" for i, w in enumerate(["garden", "news", "loans", "pills", "loans", "pills"])]


def judged(spark, times):
    urls = CLEAN + BAD + DECIDED * 2
    rows = [(i, "http://" + u, "garden news school free casino porn spam bet poker lake loans pills") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.crossJoin(spark.range(times)).drop("id")
    got = url_filter.judged_urls(pages).select("page_id", "rule", "verdict").distinct().collect()
    assert len(got) == len(rows)
    return {urls[r["page_id"]]: (r["rule"], r["verdict"]) for r in got}


@pytest.mark.parametrize("times", [1, 300])
def test_planted_hosts(spark, times):
    got = judged(spark, times)
    assert {u: got[u] for u in CLEAN} == {u: (None, "allow") for u in CLEAN}
    assert {u: got[u] for u in BAD} == {u: (None, "block") for u in BAD}


def test_verdicts_do_not_change_with_the_size(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url", "html")
    once, often = (
        {(r["page_id"], r["verdict"]) for r in url_filter.judged_urls(p).collect()}
        for p in (pages, pages.crossJoin(spark.range(20)).drop("id"))
    )
    assert once == often
