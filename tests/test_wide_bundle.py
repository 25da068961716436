from tixprep import session
from tixprep.queries import q_evaluate as Q

SF = "/root/testdata/sf0.001"


def test_texts_of_the_wide_bundle_are_written_once(spark, monkeypatch):
    """The finished samples go to the bundle only; no table of them is written beside it."""
    kept, write = [], session.write_table
    monkeypatch.setattr(session, "write_table", lambda df, *a: (kept.append(df.columns), write(df, *a))[1])
    rows = Q.q_sink_bundle_wide(spark, SF)
    assert rows.count() > 0 and not any("aug_no" in c and "text" in c for c in kept)
