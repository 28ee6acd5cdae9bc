"""Prompt templates as one concatenation of literals and columns.

A template is cut once, on the driver; filling it is a plain ``concat``. The
text put in is never scanned again, so marks inside it stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.fixed_values import STYLE_LANGUAGE

# {{name}}, {{name|default}}, ${name}, $name and $$.
MARK = re.compile(r"\{\{(\w+)(?:\|([^}]+))?\}\}|\$(?:(\$)|\{(\w+)\}|([A-Za-z_]\w*))")


def fill(template: str, values: Mapping[str, Column | str | int | float]) -> Column:
    """The template with its marks replaced.

    An unknown ``{{name}}`` becomes its default or nothing, an unknown
    ``${name}`` stays. A null value counts as unknown.
    """
    pieces: list[Column] = []
    at = 0
    for mark in MARK.finditer(template):
        pieces.append(F.lit(template[at : mark.start()]))
        at = mark.end()
        name, default, dollar, braced, plain = mark.groups()
        if dollar:
            pieces.append(F.lit("$"))
            continue
        value = values.get(name or braced or plain)
        otherwise = F.lit((default or "") if name else mark.group(0))
        if value is None:
            pieces.append(otherwise)
        elif isinstance(value, Column):
            pieces.append(F.coalesce(value.cast("string"), otherwise))
        else:
            pieces.append(F.lit(str(value)))
    pieces.append(F.lit(template[at:]))
    return F.concat(*pieces)


# Wording of our own; a job may pass any other template with the same marks.
ANALYSIS_TEMPLATE = """\
Descreva o estilo de quem fala no trecho abaixo, em {{idioma|%s}}, só com o que o trecho mostra.
A resposta é um único objeto JSON, sem cercas e sem comentários. Sem evidência: null ou [].
No máximo {{max_itens|10}} itens por lista, do mais ao menos relevante.
Campos:
- tom, humor, ritmo, ritmo_comico: texto
- estruturas_piada: [{formato, exemplo, marcadores_lexicais: [texto]}]
- gatilhos_comicos: [{tipo, intensidade, exemplo}]
- moldes_frasais: [{molde, uso}]
- vicios_expressao: [{texto, exemplo}]
- marcadores_discurso: [{texto, frequencia_estimada}]
- bordoes: [{texto, exemplo}]
- interjeicoes: [{texto}]
- temas_recorrentes: [{tema}]
- pontuacoes_enfase: {caixa_alta, pausas_elongadas}
- exemplos_representativos: [texto]
- confianca_global: número de 0 a 1

Trecho:
{{trecho}}
""" % STYLE_LANGUAGE
