from __future__ import annotations

import pytest
from conftest import tuples

from docloom.operators import folders as f

SCHEMA = "id long, name string, parent_id long"


@pytest.fixture()
def tree(table):
    return table(SCHEMA, (1, "2026", None), (2, "jan", 1), (3, "feb", 1), (4, "x", 2), (5, "lost", 77))


def test_paths_and_closure(tree):
    paths = f.folder_paths(tree)
    assert tuples(f.full_paths(paths)) == sorted([
        (1, 0, "2026"), (2, 1, "2026/jan"), (3, 1, "2026/feb"), (4, 2, "2026/jan/x"), (5, 0, "lost")], key=repr)
    assert (1, 4, 2) in tuples(f.folder_closure(paths))
    assert len(tuples(f.folder_closure(paths))) == 9
    assert tuples(f.subtree_ids(tree, [2])) == [(2,), (4,)]


def test_deep_chain(table):
    chain = table(SCHEMA, *[(i, f"n{i}", i - 1 if i else None) for i in range(200)])
    deepest = f.folder_paths(chain).where("id = 199").first()
    assert list(deepest["path_ids"]) == list(range(200))


def test_cycle_is_an_error(table):
    loop = table(SCHEMA, (1, "a", 2), (2, "b", 1), (3, "c", None))
    with pytest.raises(ValueError, match="cycle"):
        f.folder_paths(loop)
    assert tuples(f.subtree_ids(loop, [1])) == [(1,), (2,)]


def test_resolve_creates_once_and_repeats(tree, table):
    wanted = table("n long, path string", (0, "2026/jan"), (1, "/2026//mar/"), (2, "2026/mar"), (3, " / "), (4, "new"))
    out = f.resolve_folder_paths(tree, wanted)
    assert tuples(out.created, "id", "name", "parent_id") == sorted([(6, "new", None), (7, "mar", 1)], key=repr)
    got = {r["n"]: (list(r["folder_ids"]), list(r["folder_names"])) for r in out.resolved.collect()}
    assert got == {0: ([1, 2], ["2026", "jan"]), 1: ([1, 7], ["2026", "mar"]), 2: ([1, 7], ["2026", "mar"]), 4: ([6], ["new"])}
    assert tuples(out.invalid, "n") == [(3,)]
    again = f.resolve_folder_paths(out.folders, wanted)
    assert again.created.isEmpty()
    assert tuples(f.leaf_folders(again), "n", "leaf_id") == [(0, 2), (1, 7), (2, 7), (4, 6)]


def test_resolve_below_a_base(tree, table):
    out = f.resolve_folder_paths(tree, table("path string", ("x/y",)), parent_id=2)
    row = out.resolved.first()
    assert list(row["folder_ids"]) == [4, 6] and list(row["folder_names"]) == ["x", "y"]
    with pytest.raises(ValueError, match="no folder"):
        f.resolve_folder_paths(tree, table("path string", ("x",)), parent_id=1234)


def test_move_classes(table):
    folders = table(SCHEMA, (1, "a", None), (2, "b", 9), (3, "taken", None), (4, "taken", 9), (5, "a", 3), (9, "t", 8), (8, "up", None))
    out = f.move_folders(folders, table("id long", (1,), (2,), (3,), (5,), (8,), (9,), (404,)), target_parent_id=9)
    assert dict(tuples(out.classified, "id", "outcome")) == {
        1: "moved", 2: "already_in_target", 3: "name_conflict", 5: "duplicate_in_selection",
        8: "invalid_parent", 9: "invalid_parent"}
    summary = out.summary().first()
    assert (summary["matched"], summary["moved"], summary["invalid_parent"]) == (6, 1, 2)
    assert dict(tuples(out.folders, "id", "parent_id"))[1] == 9


def test_move_to_root(tree, table):
    out = f.move_folders(tree, table("id long", (4,), (1,)))
    assert dict(tuples(out.classified, "id", "outcome")) == {4: "moved", 1: "already_in_target"}
    assert dict(tuples(out.folders, "id", "parent_id"))[4] is None


def test_bulk_delete(tree, table):
    out = f.delete_folders(tree, table("id long", (1,), (99,)))
    assert tuple(out.summary().first()) == (2, 1)
    assert tuples(out.classified, "id", "outcome") == [(1, "deleted"), (99, "not_found")]
    whole = f.delete_folders(tree, table("id long", (2,), (99,)), subtree=True)
    assert tuples(whole.folders, "id") == [(1,), (3,), (5,)]
    assert tuple(whole.summary().first()) == (2, 2)


def test_change_set(tree, table):
    changes = table(
        "change_id long, action string, id long, name string, parent_id long",
        (1, "create", None, "mar", 1), (2, "create", None, "mar", 1), (3, "create", None, "jan", 1),
        (4, "rename", 3, "march", None), (5, "rename", 2, "jan", None), (6, "rename", 404, "z", None),
        (7, "create", None, "2026", None), (8, "create", None, "2027", None),
    )
    out = f.apply_folder_changes(tree, changes)
    assert tuples(out.conflicts, "change_id", "code") == [
        (2, "NAME_ALREADY_EXISTS"), (3, "NAME_ALREADY_EXISTS"), (6, "NOT_FOUND"), (7, "NAME_ALREADY_EXISTS")]
    got = {r["id"]: (r["name"], r["parent_id"]) for r in out.folders.collect()}
    assert got[3] == ("march", 1) and got[2] == ("jan", 1) and got[6] == ("mar", 1) and got[7] == ("2027", None)


def test_has_children(tree):
    assert tuples(f.with_has_children(tree), "id", "has_children") == [
        (1, True), (2, True), (3, False), (4, False), (5, False)]


@pytest.mark.parametrize("as_table", [False, True])
def test_subtrees_by_pointer_doubling(table, as_table):
    chain = [(n, f"n{n}", n - 1 if n > 1 else None) for n in range(1, 41)]  # forty levels
    bushes = [(100 + n, f"b{n}", 5 if n % 2 else 100 + n // 2) for n in range(1, 60)]
    odd = [(900, "lost", 12345), (901, "round", 902), (902, "about", 901), (903, "off", 902), (None, "nameless", 3)]
    rows = chain + bushes + odd
    folders = table("id long, name string, parent_id long", *rows)
    parent = {i: up for i, _, up in rows}

    def inside(i, roots):
        seen = set()
        while i is not None and i in parent and i not in seen:
            if i in roots:
                return True
            seen.add(i)
            i = parent[i]
        return False

    for roots in ([1], [5, 30], [100], [903], [902], [777], [40, 40, 1, 2]):
        given = table("wanted long", *[(r,) for r in roots]) if as_table else roots
        found = [r["id"] for r in f.subtree_ids(folders, given).collect()]
        assert sorted(found) == sorted(i for i in parent if i is not None and inside(i, set(roots)))
