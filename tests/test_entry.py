import __spark_entry__ as E
from courtside.plans import catalog
from courtside.functions import constants as K


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == list(K.AVERAGES_COLUMNS)
    assert df.count() > 0


def test_registry_contract():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    own = set(catalog.all_queries())   # others come with the removable corpus subpackage
    assert own <= set(qs) and own - set(sql) == {"resolve_names_cascade"}   # rows-only: weighted ratio has no SQL twin
    for name in qs:
        assert isinstance(name, str) and callable(qs[name])
