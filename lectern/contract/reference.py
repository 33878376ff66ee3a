"""The contract's tables as text, from the schema itself."""

from __future__ import annotations

from lectern.contract import schema


def render(tables: tuple[schema.Table, ...] = schema.TABLES) -> str:
    lines = [f"# {schema.NAME} {schema.VERSION}"]
    for t in tables:
        lines += ["", f"## {t.name} ({'required' if t.required else 'optional'})", "", f"key: {', '.join(t.key)}", ""]
        lines += [f"- {f.name}: {f.type.simpleString()}{', may be null' if f.nullable else ''}{', one of ' + ', '.join(f.allowed) if f.allowed else ''}" for f in t.fields]
        lines += [f"- rule {r.id}: {r.then} is {'filled' if r.filled else 'empty'} where {r.when} is {' or '.join(r.values)}" for r in t.rules]
    return "\n".join(lines) + "\n"
