"""Inspected examples: kinds of text with their class. Written for this purpose; none is taken from a corpus."""

from __future__ import annotations

_PROSE = "El capítulo describe cómo se eligieron las parcelas y por qué algunas quedaron fuera. En la segunda visita, los dueños dijeron que el agua llega tarde y que la acequia se rompe cada año."
_ENGLISH = "The second chapter explains how the plots were chosen and why some of them were left out. We don't know whether the owners would agree, but it is a good place to start."
_PORTUGUESE = "O segundo capítulo explica como as áreas foram escolhidas e por que algumas não entraram. As famílias disseram que a água chega tarde, mas que não há outra saída para a região."
_WORDS = "barro lana trigo puente molino horno plaza fuente camino sierra".split()
_NAMES = ("Marta Peralta", "Juana Robles", "Inés Cuevas", "Luisa Arce", "Rita Salinas", "Alma Ponce", "Nora Vidal", "Elsa Rojas")
_CELLS = (("12.5", "s/d", "48 %", "-"), ("7.01", "barro", "-", "1930"), ("s/d", "66 %", "812", "lana"), ("3.3", "-", "9 %", "s/d"), ("2041", "18.2", "s/d", "5 %"))
_HEAD = ("año", "casos", "media", "total")


def _wrap(text: str, width: int) -> str:
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(line.strip())
            line = ""
        line += w + " "
    return "\n".join([*out, line.strip()])


def _bare(text: str) -> str:
    return "".join(c for c in text.lower() if c.isalnum() or c in " '")


def _table(sep: str, edge: str = "") -> str:
    return "\n".join(edge + sep.join(row) + edge for row in (_HEAD, *_CELLS))


def _columns() -> str:
    return "\n".join("".join(c.ljust(14) for c in row).rstrip() for row in (_HEAD, *_CELLS))


def _boxes() -> str:
    rule = "+" + "------------+" * 4
    return "\n".join(x for row in (_HEAD, *_CELLS) for x in (rule, "|" + "|".join(c.center(12) for c in row) + "|"))


def _noise(text: str, every: int) -> str:
    signs = "@#|}~¬°<>=_^*{"
    return "".join(signs[i % len(signs)] if i % every == 1 and c != "\n" else c for i, c in enumerate(text))


_SOUP = "¿Ã±¬³š“€Â½ï„Å©â‚ƒ¢"
_PAGE = '<div class="x"><td></td>&nbsp;</a><br/><a href="#">{ }</div>'

EXAMPLES = [
    ("prose", "prosa", [_PROSE * 3, _PROSE]),
    ("prose short", "prosa", [_PROSE[:80] + ".", "Hay reglas que conviene revisar con cuidado."]),
    ("prose english", "prosa", [_ENGLISH * 2, _ENGLISH]),
    ("prose portuguese", "prosa", [_PORTUGUESE * 2, _PORTUGUESE]),
    ("prose repetitive", "prosa", [_ENGLISH * 14, _PORTUGUESE * 10, _wrap(_PROSE * 12, 70)]),
    ("prose with odd ends", "prosa", [_PROSE + " 🙂🙂", _PROSE[:70] + " 01234567890123456789012345678901234567890123456789", _ENGLISH[:75] + " 🎓"]),
    ("prose figures", "prosa", ["Se midieron 81 muestras de 40 mL a una temperatura media de 22.5 °C (Peralta, 1987). Entre 1951 y 1974 hubo 12 casos en 9 de cada diez pueblos.", "SE MIDIERON 81 MUESTRAS DE 40 ML A UNA TEMPERATURA MEDIA DE 22.5 °C.", "se midieron 81 muestras de 40 ml a una temperatura media de 225 °c entre 1951 y 1974 hubo 12 casos"]),
    ("prose bare", "prosa", [_bare(_PROSE * 2), _bare(_ENGLISH * 2), _bare(_PORTUGUESE)]),
    ("prose capitals", "prosa", [(_PROSE * 2).upper(), _ENGLISH.upper()]),
    ("prose wrapped", "prosa", [_wrap(_PROSE * 2, 60), _wrap(_ENGLISH * 2, 46), _wrap(_PROSE, 40)]),
    ("prose end of line", "prosa", ["cada año.", "acequia se rompe."]),
    ("heading", "prosa", ["Estudio del trigo y del barro en la sierra", "Propuesta para el molino en la plaza de abajo"]),
    ("prose in lines", "prosa", [_PROSE.replace(". ", ".\n") + "\n" + _PORTUGUESE.replace(". ", ".\n")]),
    ("words by lines", "lista", ["\n".join(_WORDS), "\n".join(reversed(_WORDS * 2))]),
    ("words by signs", "lista", [s.join(_WORDS * 2) for s in (", ", "; ", " / ", " · ")]),
    ("words by signs short", "lista", [s.join(_WORDS[:8]) for s in (", ", "; ", " / ", " · ", " | ")]),
    ("items", "lista", ["\n".join(f"{m} Conocer el uso de la {w}{e}" for w, e in zip(_WORDS, ".;,.;..;,.")) for m in ("*", "-", "•", "a)")]),
    ("numbered names", "lista", ["\n".join(f"{i + 1}. {x}" for i, x in enumerate(_NAMES)), "\n".join(f"{i + 1}) {x}" for i, x in enumerate(_NAMES[:4]))]),
    ("names by lines", "lista", ["\n".join(_NAMES)]),
    ("index", "lista", ["\n".join(f"{1 + i // 3}.{1 + i % 3} El cultivo de {w} {'.' * (20 + 3 * i)} {7 + 12 * i}" for i, w in enumerate(_WORDS))]),
    ("entries", "lista", ["\n".join(f"{x.split()[1]}, {x[0]}. ({1950 + 7 * i}). Notas sobre {w}. Villa Nueva: Ed. del Sur." for i, (x, w) in enumerate(zip(_NAMES, _WORDS)))]),
    ("table tabs", "tabla", [_table("\t")]),
    ("table pipes", "tabla", [_table(" | ", "|"), _table("|")]),
    ("table boxes", "tabla", [_boxes()]),
    ("table columns", "tabla", [_columns()]),
    ("table semicolons", "tabla", [_table(";")]),
    ("table pairs", "tabla", ["\n".join(", ".join(f"{h}={c}" for h, c in zip(_HEAD, row)) for row in _CELLS)]),
    ("repetition", "basura", ["barro " * 60, "trigo " * 25]),
    ("letters", "basura", ["xkqjd wvrtpl ñzoqh jqwkzrt uhgbvx ptlkmnq ydfgrw qxzvbn rtkplmq iuwqxz dñkqrj vbnmtrq " * 2, "qwrtz plkjh gfdxc vbnmq wzxkt rpqjd"]),
    ("letters no blanks", "basura", ["R8kQ/v1LmZ+t3XyW0pBs9dGhJq7NfCe2UaViTo6K\nzP4rE5wM+bSx/lY8nDqGt1HkJfZc0OvAuIi3W7Ep\nQ9xL2mT/sK6vRyB4gNhDoC1jZfUwPe8Xa+SqMi5V"]),
    ("soup", "basura", [_SOUP * 8, _SOUP[::-1] * 3, _SOUP[3:] + _SOUP]),
    ("signs", "basura", [r"~'i$;#]tQ)0\.}\/l!{>:;@|Q!%$)lO(@<`f)O}],Ir<]>^`$:`1,~o) 1>Q`{)#,I1[,t.}t]Q!)[;n],{]" * 2, "#]{~ ^`|}> <)( &%$"]),
    ("noise in prose", "basura", [_noise(_PROSE * 2, 3), _noise(_PROSE, 4), _noise(_ENGLISH, 3)]),
    ("rules", "basura", ["*" * 50 + "\n" + "=" * 60 + "\n" + "." * 40 + "\n" + "#" * 30, "-" * 40 + "\n" + "~" * 55 + "\n" + "_" * 20]),
    ("markup", "basura", [_PAGE * 5, (_PAGE + "function(){}") * 3]),
    ("page numbers", "basura", ["\n".join(f"{i}{e}" for i, e in enumerate(("", " ..", " /", "", " ..", "", " /", ""), 1))]),
]
