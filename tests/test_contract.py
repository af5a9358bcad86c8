import pytest

from tidemark.contract import TPCH_CONTRACT, Contract, ForeignKey, Table, Column
from tidemark.plans.oracle import DRIVER_CONTRACT


def test_contract_size():
    assert len(TPCH_CONTRACT.tables) == 8
    assert TPCH_CONTRACT.column_count == 61
    assert len(TPCH_CONTRACT.foreign_keys) == 10


def test_rule_names():
    names = [f"{fk.child}.{fk.rule_name}" for fk in TPCH_CONTRACT.foreign_keys]
    assert "lineitem.fk_partsupp_part_key_supp_key" in names
    assert "nation.fk_region_region_key" in names
    assert len(set(names)) == 10


def test_nullable_columns_are_comments_and_ship_instruct():
    nullable = {(t.name, c.name) for t in TPCH_CONTRACT.tables for c in t.columns if c.nullable}
    assert {c for _, c in nullable} == {"comment", "ship_instruct"}
    assert len(nullable) == 9


def test_fk_must_be_whole_parent_key():
    a = Table("a", (Column("x", "x", "BIGINT", False), Column("y", "y", "BIGINT", False)), ("x", "y"))
    b = Table("b", (Column("x", "x", "BIGINT", False),), ("x",))
    with pytest.raises(ValueError, match="whole primary key"):
        Contract((a, b), (ForeignKey("b", ("x",), "a"),))


def test_fk_types_must_match():
    a = Table("a", (Column("x", "x", "INT", False),), ("x",))
    b = Table("b", (Column("x", "x", "BIGINT", False),), ("x",))
    with pytest.raises(ValueError, match="type"):
        Contract((a, b), (ForeignKey("b", ("x",), "a"),))


def test_driver_contract_keeps_keys_and_all_fks():
    assert len(DRIVER_CONTRACT.tables) == 8
    assert len(DRIVER_CONTRACT.foreign_keys) == 10
    assert DRIVER_CONTRACT.table("lineitem").names[-3:] == ["commit_date", "receipt_date", "ship_mode"]


def test_struct_and_ddl():
    region = TPCH_CONTRACT.table("region")
    assert region.ddl() == "`region_key` BIGINT NOT NULL, `name` STRING NOT NULL, `comment` STRING"
    assert [f.nullable for f in region.struct().fields] == [False, False, True]
