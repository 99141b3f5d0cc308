import pytest

from tidemark.operators import telemetry
from tidemark.operators.cadence import DEFAULT_TIERS
from tidemark.settings import Settings, limit, or_default
from tidemark.sources import plugin
from tidemark.sources.snapshot import Memo


@pytest.mark.parametrize("value,want", [(None, 8), ("", 8), ("0", 8), ("x", 8), ("12", 12), (" 3 ", 3), ("0x10", 16), ("-1", -1), ("1e2", 100), ("0.5", 0.5)])
def test_numbers_that_cannot_be_zero(value, want):
    assert or_default(value, 8) == want


@pytest.mark.parametrize("value,want", [(None, 4), ("", 4), ("  ", 4), ("0", 0), ("-1", 4), ("x", 4), ("Infinity", 4), ("6", 6)])
def test_limit_that_zero_switches_off(value, want):
    assert limit(value, 4) == want


def test_settings():
    assert Settings.read({}) == Settings()
    s = Settings.read({"CRON_TIERS": "9:1,*:5", "CHAPTER_REFRESH_WINDOW": "0", "CHAPTER_DELTA_UPSERT": "No", "CRON_SOURCE_CONCURRENCY": "0"})
    assert (len(s.tiers), s.refresh_window, s.delta_upsert, s.source_concurrency) == (2, 5, False, 0)
    assert Settings.read({"CRON_TIERS": "nonsense"}).tiers == DEFAULT_TIERS


def test_a_failed_load_waits():
    calls = []

    def load():
        calls.append(1)
        if len(calls) < 2:
            raise OSError
        return "loaded"

    r = Memo(load, "default", 60)
    assert [r.get(t) for t in (0, 30, 59, 60, 61)] == ["default", "default", "default", "loaded", "loaded"] and len(calls) == 2


def test_failures_annotations_and_numbers(spark):
    f = spark.createDataFrame([(i, f"T{i}", "HTTP 500") for i in range(25)], "series long, title string, error string")
    lines = telemetry.failure_lines(f)
    assert lines[0] == "25 series failed:" and lines[1] == "  - T0 (0): HTTP 500" and len(lines) == 22 and lines[-1] == "  and 5 more"
    assert telemetry.failure_lines(f.filter("series < 0")) == [] and len(telemetry.failure_lines(f.filter("series < 20"))) == 21
    assert telemetry.annotations(["a"], "t") == ["::warning title=t::a"]
    assert [telemetry.ms_text(x) for x in (840, 999.6, 1450, 8250, 59999, 60500)] == ["840ms", "1000ms", "1.4s", "8.3s", "60.0s", "1m01s"]
    assert [telemetry.whole(x) for x in (0.5, 1.5, 2.4999)] == ["1", "2", "2"]
    trips = spark.createDataFrame([("a", 5), ("b", None)], "provider string, tripped_at long")
    assert [(r.provider, r.kind) for r in telemetry.tripped_alerts(trips).collect()] == [("a", "tripped")]


def test_names_of_sources_stand_once():
    site = plugin.theme_site("A", "https://a")
    assert plugin.registered([site, plugin.fragment_site("B", "https://b")]) == [("A", "manhwa", True, 0), ("B", "multiple", True, 1)]
    with pytest.raises(ValueError):
        plugin.registered([site, site])


def test_registry_by_name():
    sources = [plugin.theme_site("Some Site", "https://a"), plugin.fragment_site("B", "https://b")]
    assert plugin.lookup(sources, "somesite") is sources[0] and plugin.lookup(sources, "SOME  SITE") is sources[0] and plugin.lookup(sources, "c") is None
    assert [s.enabled for s in plugin.switched(sources, "b", False)] == [True, False]
    assert plugin.switched(sources, "c", False) == sources
    bare = plugin.boxed_site("C", "https://c", "katana", ".x")
    with pytest.raises(ValueError, match="no search"):
        plugin.find(bare, None)
