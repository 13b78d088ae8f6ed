"""Mutations applied one by one to a dict: the sequential meaning of a change log."""


def apply(base, log, mode, insert_only=(), names=("a", "b")):
    """base: {key: row dict}; log: (key, op, {column: value set}) in order."""
    table = {k: dict(r) for k, r in base.items()}
    for key, op, cells in log:
        if op == "delete":
            table.pop(key, None)
        elif key not in table:
            table[key] = {n: cells.get(n) for n in names}
        elif mode == "replace":
            table[key] = {n: cells.get(n) for n in names}
        elif mode == "update":
            table[key].update({n: v for n, v in cells.items() if n not in insert_only})
    return table


def conditional(base, log, column, compare, null_as=None, names=("a", "b")):
    table = {k: dict(r) for k, r in base.items()}
    for key, op, cells in log:
        if key not in table:
            if op == "put":
                table[key] = {n: cells.get(n) for n in names}
            continue
        old = table[key][column] if table[key][column] is not None else null_as
        if compare(cells.get(column), old):
            if op == "delete":
                del table[key]
            else:
                table[key] = {n: cells.get(n) for n in names}
    return table
