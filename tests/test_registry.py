"""Every operator ID of the blueprint has a registered query; oracles only
for registered queries; names are unique and lower case."""

import __spark_entry__ as E

IDS = ([f"s{i}" for i in range(1, 14)] + [f"m{i}" for i in range(1, 5)]
       + [f"d{i}" for i in range(1, 18)] + [f"f{i}" for i in range(1, 6)]
       + [f"j{i}" for i in range(1, 7)] + [f"a{i}" for i in range(1, 6)]
       + [f"w{i}" for i in range(1, 10)] + [f"x{i}" for i in range(1, 10)]
       + [f"q{i}" for i in range(1, 4)])
# full outputs that SQL cannot give; all but x2 (hashed terms may collide) have a
# second query with their checkable part and an oracle
ROWS_ONLY = {"s11_landing_report", "s13_model_files", "x2_embed", "x4_fit_models", "x5_predict",
             "x7_score_batch", "x8_score_stream"}


def test_every_id_is_registered():
    names = list(E.queries())
    for op in IDS:
        assert any(n.startswith(op + "_") for n in names), op


def test_oracles_cover_all_but_rows_only_ids():
    oracles = E.oracle_sql()
    assert set(oracles) <= set(E.queries())
    for name in E.queries():
        op = name.split("_", 1)[0]
        if op.startswith("op") or name == "pipeline":
            continue  # the document operators have tests of their own
        assert (name in oracles) == (name not in ROWS_ONLY), name
    for name in ROWS_ONLY - {"x2_embed"}:
        op = name.split("_", 1)[0]
        assert any(n.startswith(op + "_") for n in oracles), name
    assert all(n == n.lower() for n in E.queries())
