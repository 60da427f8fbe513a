"""Registered queries against their SQL. All of them with TOUCHLINE_ALL=1, else a selection."""

import os

import pytest

import __spark_entry__ as entry
from conftest import SF
from oracle_check import compare, connect
from touchline.plans.catalog import QUERIES
from touchline.plans.oracles import ORACLES

QUICK = ["a01_team_passing", "a05_ppda", "a12_shots", "a17_team_defending", "a19_team_discipline", "w01_sca", "w03_receivers", "w10_sequence_rows", "w12_states",
         "x03_player_xwalk", "s12_upsert", "s26_odds_long", "p02_cast_text", "f02_leading_number", "m16_fct_shots"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("TOUCHLINE_ALL") else QUICK)
def test_query_equals_sql(spark, con, name):
    result = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert result is None, result


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
