from pathlib import Path

import pytest
from oracle import same

from tidemark.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_agrees_with_its_sql(spark, small, name):
    same(spark, small, registry.QUERIES[name], registry.ORACLES[name])


def test_titles_that_were_cut_agree_with_their_sql(spark, small, tmp_path):
    for path in Path(small).iterdir():
        (tmp_path / path.name).symlink_to(path)
    (tmp_path / "pages.parquet").unlink()
    titles = ["a&amp;b &amp", "&amp;amp; &lt", "&#x27;x&#x2", "&eacute;&copy", "<b>&gt;</b>\n", "", "x</title><svg><title>y"]
    pages = [f"<head><title>{t}</title><p>z" for t in titles] + ["<title>never &amp; closed", "<p>none", None]
    rows = list(enumerate(pages))
    spark.createDataFrame([(i, "u", t) for i, t in rows + rows[:2]], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    same(spark, str(tmp_path), registry.QUERIES["page_titles"], registry.ORACLES["page_titles"])


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_report_counts_every_attempt(spark, small):
    found, outcomes, busy = 0, {}, {}
    for e in spark.read.parquet(f"{small}/events.parquet").collect():
        outcomes.setdefault(e.user_id, []).append(e.value > 30)
        busy[e.user_id] = max(busy.get(e.user_id, 0), e.value)
        found += 0 if e.value > 30 or e.value < 5 else e.event_id % 9 + 1
    spent = left = 0
    for series in sorted(busy):
        left += spent >= 20_000
        spent += int(busy[series])
    text = [r.text for r in registry.QUERIES["run_report"](spark, small).orderBy("line").collect()]
    assert f"| Processed | {len(outcomes)}{f' ({left} left for the next run: deadline)' if left else ''} |" in text
    assert f"| Updated | {sum(not all(v) for v in outcomes.values())} / {len(outcomes)} |" in text
    assert f"| Rows found | {found} |" in text
    counted = registry.QUERIES["delta_counters"](spark, small).groupBy().sum("upserted", "inserted").first()
    assert f"| Rows written | {counted[0]} ({counted[1]} new) |" in text


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
