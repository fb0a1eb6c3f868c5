"""Types, schemas and their changes."""

import pytest

from deltaloom import catalog as C

t = C.Type.parse
TABLE = C.TableId.parse("app.public.users")


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        ("INT", "INT", "INT"), ("TINYINT", "BIGINT", "BIGINT"), ("INT", "FLOAT", "DOUBLE"), ("SMALLINT", "FLOAT", "FLOAT"), ("BIGINT", "DOUBLE", "DOUBLE"), ("DECIMAL(10,2)", "INT", "DECIMAL(12, 2)"), ("DECIMAL(10,2)", "DECIMAL(5,4)", "DECIMAL(12, 4)"),
        ("DECIMAL(38,10)", "DECIMAL(38,2)", "DECIMAL(38, 2)"), ("DECIMAL(10,2)", "DOUBLE", "STRING"), ("TIMESTAMP(3)", "TIMESTAMP_LTZ(6)", "TIMESTAMP_LTZ(6)"), ("TIMESTAMP_TZ(0)", "TIMESTAMP(9)", "TIMESTAMP_TZ(9)"), ("DATE", "TIMESTAMP(0)", "TIMESTAMP(9)"),
        ("BOOLEAN", "INT", "STRING"), ("VARCHAR(3)", "VARCHAR(5)", "STRING"), ("TIME(3)", "TIME(6)", "STRING"), ("INT NOT NULL", "INT", "INT"), ("INT NOT NULL", "BIGINT NOT NULL", "BIGINT NOT NULL"),
    ],
)
def test_least_common_type(a, b, want):
    assert str(C.least_common_type(t(a), t(b))) == want
    assert str(C.least_common_type(t(b), t(a))) == want


def test_types_parse_and_print():
    for text in ("DECIMAL(10, 2) NOT NULL", "ARRAY<INT>", "MAP<STRING NOT NULL, ARRAY<STRING>>", "ROW<a INT NOT NULL, b ROW<c STRING>>", "TIMESTAMP_LTZ(3)", "VARIANT"):
        assert str(t(text)) == text
        assert str(t(str(t(text)))) == text
    with pytest.raises(ValueError):
        t("WHATEVER")


def test_tables():
    assert TABLE.parts == ("app", "public", "users") and str(TABLE) == "app.public.users"
    for bad in ("", "a..b", "a.b.c.d"):
        with pytest.raises(ValueError):
            C.TableId.parse(bad)


def users():
    return C.Schema.of(("id", "BIGINT"), ("name", "VARCHAR(17)"), ("age", "INT"), keys=["id"])


def test_keys_take_no_null():
    assert not users()["id"].type.nullable
    with pytest.raises(ValueError):
        users().keyed(("nothing",))


def test_changes():
    extra = C.Column("x", t("INT"))
    for where, anchor, want in (("FIRST", None, 0), ("LAST", None, 3), ("BEFORE", "age", 2), ("AFTER", "id", 1)):
        now = C.apply_change(users(), C.Change(TABLE, "add.column", added=((extra, where, anchor),)))
        assert now.names.index("x") == want
        assert C.is_redundant(now, C.Change(TABLE, "add.column", added=((extra, where, anchor),)))
    with pytest.raises(ValueError):
        C.apply_change(users(), C.Change(TABLE, "add.column", added=((extra, "AFTER", "nothing"),)))
    renamed = C.apply_change(users(), C.Change(TABLE, "rename.column", renamed=(("id", "key"),)))
    assert renamed.primary_keys == ("key",)
    assert C.apply_change(users(), C.Change(TABLE, "drop.column", dropped=("age",))).names == ["id", "name"]
    assert str(C.apply_change(users(), C.Change(TABLE, "alter.column.type", types=(("age", t("BIGINT")),)))["age"].type) == "BIGINT"
    assert not C.is_redundant(users(), C.Change(TABLE, "truncate.table"))


def test_schemas_merge():
    other = C.Schema.of(("id", "BIGINT"), ("age", "DOUBLE"), ("city", "STRING"), keys=["id"])
    both = C.least_common_schema(users(), other)
    assert both.names == ["id", "name", "age", "city"] and str(both["age"].type) == "DOUBLE"
    assert C.is_compatible(both, other) and C.is_compatible(both, users()) and not C.is_compatible(users(), other)
    kinds = [c.kind for c in C.difference(TABLE, users(), both)]
    assert kinds == ["add.column", "alter.column.type"]
    now = users()
    for change in C.difference(TABLE, users(), both):
        now = C.apply_change(now, change)
    assert now == both


def test_changes_through_projections():
    add = C.Change(TABLE, "add.column", added=((C.Column("x", t("INT")), "LAST", None), (C.Column("y", t("INT")), "FIRST", None)))
    assert C.transformed_change(add, False, ["id"]) is None
    assert [(w, a) for _, w, a in C.transformed_change(add, True, ["id", "age"]).added] == [("AFTER", "age"), ("BEFORE", "id")]
    alter = C.Change(TABLE, "alter.column.type", types=(("age", t("BIGINT")), ("name", t("STRING"))))
    assert C.transformed_change(alter, False, ["name"]).types == (("name", t("STRING")),)


def test_lenient_and_filters():
    assert C.lenient(users(), C.Change(TABLE, "drop.table")) == []
    dropped = C.lenient(users(), C.Change(TABLE, "drop.column", dropped=("id",)))
    assert dropped[0].kind == "alter.column.type" and dropped[0].types[0][1].nullable
    assert [c.kind for c in C.lenient(users(), C.Change(TABLE, "rename.column", renamed=(("name", "nick"),)))] == ["add.column"]
    assert "truncate.table" not in C.accepted_kinds(None, None) and "drop.table" in C.accepted_kinds(None, [])
    assert C.accepted_kinds(["column"], ["drop"]) == {"add.column", "alter.column.type", "rename.column", "create.table"}
    with pytest.raises(ValueError):
        C.accepted_kinds(["nonsense"], None)
