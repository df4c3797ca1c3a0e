"""Landing files listed from the last name."""

import pytest

from tests.test_streaming import AS_OF, HEADER, cfg_for, write
from tierflow.plans.pipeline import run_update
from tierflow.sinks.tables import TableStore
from tierflow.sources import listing


def reader(root, **options):
    return listing.NamesReader({"path": f"{root}/land", "log": f"{root}/log", **{k: str(v) for k, v in options.items()}})


def names(r, start, end):
    batches = [b for p in r.partitions({"entry": start}, end) for b in r.read(p)]
    return [x.rsplit("/land/", 1)[1] for b in batches for x in b.column(0).to_pylist()]


def test_entries_offsets_and_late_names(tmp):
    r = reader(tmp, max_files=2, full_every=4, pattern="*.csv")
    assert r.latestOffset() == {"entry": -1}  # no folder yet
    for n in ("d1/a.csv", "d1/b.csv", "d2/a.csv", "d2/_hidden.csv", "d2/note.txt", "top.csv"):
        write(f"{tmp}/land/{n}", "x")
    assert r.latestOffset() == {"entry": 0} and r.latestOffset() == {"entry": 1}
    assert names(r, -1, {"entry": 1}) == ["d1/a.csv", "d1/b.csv", "d2/a.csv", "top.csv"]
    write(f"{tmp}/land/d1/aa.csv", "x")  # late: before the last name
    write(f"{tmp}/land/up.csv", "x")
    assert not listing.pending(f"{tmp}/land", f"{tmp}/log", "u*.txt")
    assert r.latestOffset() == {"entry": 2} and names(r, 1, {"entry": 2}) == ["up.csv"]
    again = reader(tmp, max_files=2, full_every=4, pattern="*.csv")  # a restart
    seen = [again.latestOffset() for _ in range(4)]
    assert seen == [{"entry": 2}] * 3 + [{"entry": 3}] and names(again, 2, seen[-1]) == ["d1/aa.csv"]
    assert names(again, -1, {"entry": 1}) == ["d1/a.csv", "d1/b.csv", "d2/a.csv", "top.csv"]  # a replay


def test_only_folders_of_later_names_are_opened(tmp, monkeypatch):
    for n in ("2024-01-01/a", "2024-01-02/a", "2024-01-02/b", "2024-01-03/a"):
        write(f"{tmp}/land/{n}", "x")
    opened, real = [], listing.pafs.FileSelector
    monkeypatch.setattr(listing.pafs, "FileSelector", lambda at, **kw: opened.append(at.rsplit("/", 1)[1]) or real(at, **kw))
    got = listing.list_after(f"{tmp}/land", "2024-01-02/a")
    assert [g[0] for g in got] == ["2024-01-02/b", "2024-01-03/a"]
    assert sorted(opened) == ["2024-01-02", "2024-01-03", "land"]
    assert listing.list_after(f"{tmp}/none", "") == []


def test_update_drains_names_and_restarts(spark, tmp):
    land = f"{tmp}/landing/nyse/bronze"
    row = "AAPL,NYSE,1.00,1,2024-01-01 10:00:00,BUY,MAIN\n"
    for k in range(5):
        write(f"{land}/f{k}.csv", f"{HEADER}\nT{k},{row}")
    cfg = cfg_for(tmp, listing="names", clean_source="off", max_files_per_trigger=2, full_listing_every=1)
    store = TableStore(spark, f"{tmp}/tables")
    run_update(spark, [cfg], store, as_of=AS_OF)
    assert len(store.batches(cfg.raw_table)) == 3
    write(f"{land}/e.csv", f"{HEADER}\nLATE,{row}")
    run_update(spark, [cfg], store, as_of=AS_OF)
    run_update(spark, [cfg], store, as_of=AS_OF)
    assert sorted(r.trade_id for r in store.read(cfg.clean_table).collect()) == ["LATE", "T0", "T1", "T2", "T3", "T4"]


def test_names_do_not_archive(tmp):
    with pytest.raises(ValueError, match="clean_source"):
        cfg_for(tmp, listing="names")
