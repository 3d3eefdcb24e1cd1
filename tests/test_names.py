import pytest

from ferry.functions.names import (ColumnNameError, column_mapping, quote_identifier, sanitize_column_name,
                                   is_sanitized_name)


@pytest.mark.parametrize("name,expected", [
    ("Order No", "ORDER_NO"), ("1st", "COL_1ST"), ("date", "DATE"), ("Straße", "STRASSE"),
    (" cust-key ", "CUST_KEY"), ("a.b(c)", "A_B_C_"),
])
def test_sanitize(name, expected):
    assert sanitize_column_name(name) == expected


def test_reserved_quoted_in_ddl_only():
    assert quote_identifier("DATE") == '"DATE"'
    assert quote_identifier("ORDER_NO") == "ORDER_NO"


def test_duplicates_and_empty_rejected():
    with pytest.raises(ColumnNameError, match="A_B"):
        column_mapping(["a b", "a_b"])
    with pytest.raises(ColumnNameError):
        sanitize_column_name("  ")


def test_is_sanitized_name():
    assert is_sanitized_name("Order No", "ORDER_NO")
    assert not is_sanitized_name("Order No", "ORDER NO")
