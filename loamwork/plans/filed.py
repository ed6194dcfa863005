"""Numbering, folds and splits by the order of lines in files, held against line numbers that are written into the files."""

from __future__ import annotations

from loamwork.operators import file_order
from loamwork.operators.positions import number_rows
from loamwork.plans.registry import query
from loamwork.sources import readers
from loamwork.workspace import fresh_path

_PARTS = 12


def _file(t, header=False):
    """Orders written by key into many files, several splits each, and read back without a key."""
    path = fresh_path(t.spark, "orders")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice").repartitionByRange(_PARTS, "o_orderkey").sortWithinPartitions("o_orderkey")
    rows.write.option("header", header).csv(path)
    return readers.read_delimited(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_totalprice double")


@query("w03_lines_in_file_order", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS line_number FROM orders")
def lines_in_file_order(t):
    return file_order.in_file_order(_file(t)).select("o_orderkey", "line_number")


@query("w02_folds_in_file_order", "SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) * 5) // (SELECT count(*) FROM orders) AS fold FROM orders")
def folds_in_file_order(t):
    return file_order.file_folds(_file(t), 5).select("o_orderkey", "fold")


@query("w01_leave_out_in_file_order", """
SELECT o_orderkey, o_custkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) BETWEEN 3 AND 6 THEN 'test' ELSE 'base' END AS split FROM orders""")
def leave_out_in_file_order(t):
    return file_order.leave_range_out_of_file(_file(t), "o_custkey", 3, 6).select("o_orderkey", "o_custkey", "split")


@query("f13_first_lines_dropped", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) WHERE n > 2")
def first_lines_dropped(t):
    return file_order.drop_first_lines(_file(t), 2).select("o_orderkey")


@query("o07_stable_sort_of_lines", """
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS place FROM orders""")
def stable_sort_of_lines(t):
    """A sort by one field that leaves lines of equal fields as the file has them, with the place of each line after it."""
    numbered = file_order.in_file_order(_file(t), "line")
    return number_rows(numbered, ["o_custkey", "line"], "place").select("o_orderkey", "o_custkey", "place")
