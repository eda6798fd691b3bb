"""Cleaning, identifiers, personal data and formats: Column to Column.

Null counts as empty throughout. Lengths and cuts are in code points.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .regex import bound, every, first, folded, hits, java, literals, squeeze, strip, sub


def filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _tidied(text: Column) -> Column:
    text = sub(text, r"\n{3,}", "", "\n\n")
    text = sub(text, r"[ \t]+\n", "", "\n")
    return strip(sub(text, r"\n\|[\s|]*\|\n", "", "\n"))


def _rules() -> Column:
    """The ordered cleaning rules: name, pattern, and strings of which a match needs one (any, where none is known)."""
    rows = [F.struct(F.lit(n).alias("name"), F.lit(java(p, f)).alias("pattern"), F.array(*map(F.lit, literals(p) or ("",))).alias("needs")) for n, p, f in V.CLEANING_RULES]
    return F.array(*rows)


def _without(text: Column, low: Column, rule: Column) -> Column:
    return F.when(F.exists(rule["needs"], lambda n: low.contains(n)), F.regexp_replace(text, rule["pattern"], F.lit(""))).otherwise(text)


def clean_text(text: Column) -> Column:
    """Delete institutional clutter by the ordered rules, then tidy blank lines and ends."""
    return _tidied(reduce(lambda t, rule: sub(t, rule[1], rule[2], ""), V.CLEANING_RULES, filled(text)))


def removal_log(text: Column) -> Column:
    """array<struct<rule, snippet, start>>: what each rule deletes from what the rules before it left."""
    none = F.array().cast("array<struct<rule:string,snippet:string,start:int>>")

    def found(t: Column, rule: Column) -> Column:
        def step(acc: Column, m: Column) -> Column:
            at = F.call_function("locate", m, t, acc["at"])
            entry = F.struct(rule["name"].alias("rule"), F.substring(m, 1, 120).alias("snippet"), (at - 1).cast("int").alias("start"))
            return F.struct((at + F.greatest(F.length(m), F.lit(1))).alias("at"), F.concat(acc["out"], F.array(entry)).alias("out"))

        return F.aggregate(F.regexp_extract_all(t, rule["pattern"], F.lit(0)), F.struct(F.lit(1).alias("at"), none.alias("out")), step)["out"]

    def walk(held: Column, rule: Column) -> Column:
        return F.struct(_without(held["t"], folded(held["t"]), rule).alias("t"), F.concat(held["out"], found(held["t"], rule)).alias("out"))

    return F.aggregate(_rules(), F.struct(filled(text).alias("t"), none.alias("out")), walk)["out"]


def doc_id(text: Column) -> Column:
    """struct<num, pag>: the last numbered footer, else the last bare number with page 1, else null."""
    text = filled(text)
    num, pag, alone = every(text, V.DOC_ID_WITH_PAGE, "i", 1), every(text, V.DOC_ID_WITH_PAGE, "i", 2), every(text, V.DOC_ID_ALONE, "i", 1)
    return F.when(F.size(num) > 0, F.struct(F.try_element_at(num, F.lit(-1)).alias("num"), F.try_element_at(pag, F.lit(-1)).alias("pag"))).when(
        F.size(alone) > 0, F.struct(F.try_element_at(alone, F.lit(-1)).alias("num"), F.lit("1").alias("pag"))
    )


def first_seen(values: Column, most: int) -> Column:
    """Distinct values in the order in which they first come, at most `most`."""
    return F.slice(F.array_distinct(values), 1, most)


def dates(text: Column) -> Column:
    d, m, y = (every(text, *V.DATE, k) for k in (1, 2, 3))
    return F.transform(F.arrays_zip(d.alias("d"), m.alias("m"), y.alias("y")), lambda x: F.concat_ws("/", x["d"], x["m"], x["y"]))


def personal_data(text: Column) -> Column:
    """struct<cpfs, rgs, telefones, ceps, datas>, each in first-seen order and capped."""
    text = filled(text)
    area, middle, end = (every(text, *V.PHONE, k) for k in (1, 2, 3))
    phones = F.filter(F.arrays_zip(area.alias("a"), middle.alias("m"), end.alias("e")), lambda x: ~x["a"].isin("19", "20"))
    phones = F.transform(phones, lambda x: F.concat(F.lit("("), x["a"], F.lit(") "), F.replace(x["m"], F.lit(" "), F.lit("")), F.lit("-"), x["e"]))
    return F.struct(
        first_seen(every(text, *V.CPF), 10).alias("cpfs"),
        first_seen(every(text, *V.RG), 5).alias("rgs"),
        first_seen(phones, 5).alias("telefones"),
        first_seen(every(text, *V.CEP), 5).alias("ceps"),
        first_seen(dates(text), 15).alias("datas"),
    )


def cover_metadata(text: Column) -> Column:
    """struct of the seven cover fields, empty where a label is missing."""
    text = filled(text)
    # Labels of the cover and the roles of the parties.
    fields = {
        "classe": r"Classe:\s*\*?\*?([^\n*]+)",
        "assunto": r"Assuntos?:\s*\*?\*?([^\n*]+)",
        "orgao": r"[ÓO]rg[ãa]o\s+julgador:\s*([^\n*]+)",
        "valor": r"Valor\s+da\s+causa:\s*R?\$?\s*([^\n*]+)",
        "distribuicao": r"(?:Última|Ultima)\s+distribui[çc][ãa]o\s*:\s*([^\n*]+)",
    }
    name = r"([A-ZÁ-Ú][A-ZÁ-Ú\s.\-&]{2,80}?)\s*"
    parties = {
        "exequente": name + r"\((?:EXEQUENTE|REQUERENTE|AUTOR|RECLAMANTE|IMPETRANTE)\)",
        "executado": name + r"\((?:EXECUTADO|REQUERIDO|R[ÉE]U|RECLAMADO|IMPETRADO)\)",
    }
    got = {k: squeeze(first(text, p, "i")) for k, p in fields.items()} | {k: squeeze(first(text, p.replace("&]", "\\&]"))) for k, p in parties.items()}
    return F.struct(*[v.alias(k) for k, v in got.items()])


def metadata_fallback(cover: Column, is_cover: Column, title: Column, subject: Column) -> Column:
    """The file's title and subject where there is no cover and it gave neither class nor subject."""
    bare = ~is_cover & (cover["classe"] == "") & (cover["assunto"] == "")
    cut = lambda c, n: F.substring(strip(filled(c)), 1, n)
    return F.when(bare, F.struct(cut(title, 100).alias("classe"), cut(subject, 200).alias("assunto"))).otherwise(F.struct(cover["classe"].alias("classe"), cover["assunto"].alias("assunto")))


def movements(text: Column) -> Column:
    """array<struct<data, descricao>> of dated lines."""
    pattern = r"(\d{2}/\d{2}/\d{4})\s{1,10}([^\n]{10,120})"
    both = F.arrays_zip(every(filled(text), pattern, "m", 1).alias("d"), every(filled(text), pattern, "m", 2).alias("x"))
    return F.transform(both, lambda m: F.struct(m["d"].alias("data"), strip(m["x"]).alias("descricao")))


def head_dates(text: Column) -> Column:
    return every(F.substring(filled(text), 1, 1500), r"\b\d{2}/\d{2}/\d{4}\b", "", 0)


CNJ = r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}"


def cnj(text: Column) -> Column:
    return F.nullif(first(filled(text), CNJ, "", 0), F.lit(""))


def case_number_of_file(name: Column) -> Column:
    """The case number that a file name holds, else the name without its extension."""
    p = r"(\d{7})[-_.]?(\d{2})[_.](\d{4})[_.](\d{1,2})[_.](\d{2})[_.](\d{4})"
    g = [first(name, p, "", k) for k in range(1, 7)]
    base = F.element_at(F.split(name, "/"), -1)
    stem = F.when(F.substring(base, 2, 1 << 20).contains("."), sub(base, r"\.[^.]*\Z", "", "")).otherwise(base)
    return F.when(hits(name, p), F.concat(g[0], F.lit("-"), g[1], F.lit("."), g[2], F.lit("."), g[3], F.lit("."), g[4], F.lit("."), g[5])).otherwise(stem)


def file_of_case_number(number: Column, extension: str = ".md") -> Column:
    return F.concat(F.translate(number, ".-", "__"), F.lit(extension))


def case_number_of_parts(name: Column) -> Column:
    """The inverse of file_of_case_number: six underscored parts, else the stem as it is."""
    stem = sub(name, r"\.[^.]*\Z", "", "")
    p = F.split(stem, "_")
    return F.when(F.size(p) >= 6, F.concat(p[0], F.lit("-"), p[1], F.lit("."), p[2], F.lit("."), p[3], F.lit("."), p[4], F.lit("."), p[5])).otherwise(stem)


def _plain_letters() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by decomposition."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in range(0xA0, 0x250)]
    pairs = [(c, "".join(x for x in d if not unicodedata.combining(x))) for c, d in pairs]
    pairs = [(c, d) for c, d in pairs if len(d) == 1 and d.isascii() and c != d]
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs)


ACCENTED, PLAIN = _plain_letters()


def without_accents(text: Column) -> Column:
    """Base letters for accented Latin ones; combining marks go."""
    return sub(F.translate(filled(text), ACCENTED, PLAIN), r"\p{Mn}", "", "")


def match_name(name: Column) -> Column:
    """A name as linkage compares it: tags off, plain lower-case letters, words sorted."""
    s = sub(filled(name), r"\s*[\(\[][^)\]]*[\)\]]\s*|\s+A\.?P\.?\s*$|\s+APF\s*$", "i", " ")
    for c, d in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE")):
        s = F.replace(s, F.lit(c), F.lit(d))
    s = F.translate(without_accents(s), "øØđĐłŁ", "oOdDlL")
    s = squeeze(F.lower(s))
    return F.array_join(F.array_sort(F.filter(F.split(s, " "), lambda w: w != "")), " ")


# Words that stay lower-case in names.
SMALL_WORDS = ["da", "de", "do", "das", "dos", "e", "di", "du", "del", "della"]


def title_name(name: Column) -> Column:
    """Squeezed, each word capitalised but for connectives after the first."""
    words = F.filter(F.split(squeeze(filled(name)), " "), lambda w: w != "")
    cap = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20)))
    return F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & F.lower(w).isin(SMALL_WORDS), F.lower(w)).otherwise(cap(w))), " ")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def format_cpf(text: Column) -> Column:
    text = filled(text)
    d = _digits(text)
    return F.when(F.length(d) == 11, F.regexp_replace(d, r"(\d{3})(\d{3})(\d{3})(\d{2})", "$1.$2.$3-$4")).otherwise(strip(text))


def format_phone(text: Column) -> Column:
    text = filled(text)
    d = _digits(text)
    d = F.when(d.startswith("55") & (F.length(d) >= 12), F.substring(d, 3, 1 << 20)).otherwise(d)
    return F.when(F.length(d) == 11, F.regexp_replace(d, r"(\d{2})(\d{5})(\d{4})", "($1) $2-$3")).when(F.length(d) == 10, F.regexp_replace(d, r"(\d{2})(\d{4})(\d{4})", "($1) $2-$3")).otherwise(strip(text))


def format_date(text: Column) -> Column:
    """DD/MM/YYYY; two-digit years up to 30 are of this century."""
    text = strip(filled(text))
    p = r"^(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{2,4})"
    d, m, y = (first(text, p, "", k) for k in (1, 2, 3))
    year = F.when(F.length(y) == 2, F.concat(F.when(y.try_cast("int") <= 30, F.lit("20")).otherwise(F.lit("19")), y)).otherwise(y)
    return F.when(hits(text, p), F.concat(F.lpad(d, 2, "0"), F.lit("/"), F.lpad(m, 2, "0"), F.lit("/"), year)).otherwise(text)


def sheet_key(text: Column) -> Column:
    """A sheet or column name for comparison: no emoji, accents or doubled spaces, lower-case."""
    s = F.regexp_replace(filled(text), r"[\x{2700}-\x{10FFFF}\p{C}\p{Zl}\p{Zp}]|[\p{Zs}&&[^ ]]", "")
    return F.lower(squeeze(without_accents(s)))


def sheet_prefix(name: Column) -> Column:
    key = sheet_key(name)
    return reduce(lambda acc, kv: F.when(key == kv[0], kv[1]).otherwise(acc), V.SHEET_PREFIXES, F.lit("grp"))


def qualification(text: Column) -> Column:
    """struct of the thirteen fields, empty where nothing is found."""
    text = filled(text)
    p = dict(V.QUALIFICATION)
    grab = {k: squeeze(first(text, v, "i")) for k, v in p.items() if k != "telefone"}
    phone = F.concat(*[first(text, p["telefone"], "", k) for k in (1, 2, 3)])
    grab |= {k: title_name(grab[k]) for k in ("nome", "filiacao_mae", "filiacao_pai")}
    grab |= {"cpf": format_cpf(grab["cpf"]), "data_nascimento": format_date(grab["data_nascimento"]), "telefone": format_phone(phone)}
    grab |= {k: strip(F.lower(grab[k])) for k in ("profissao", "estado_civil")}
    return F.struct(*[grab[k].alias(k) for k in p])


def first_line(text: Column, most: int = 120) -> Column:
    """The first line with over ten characters once marks are off, else the start of the text."""
    text = filled(text)
    lines = F.transform(F.split(text, "\n"), _unmarked)
    return F.substring(F.coalesce(F.get(F.filter(lines, lambda x: F.length(x) > 10), F.lit(0)), text), 1, most)


def _unmarked(line: Column) -> Column:
    line = sub(strip(line), r"^#+|#+\Z", "", "")
    return strip(sub(line, r"^\*+|\*+\Z", "", ""))


def decision_snippet(text: Column, most: int = 200) -> Column:
    """The first line with a verb of decision; else the first that is no preamble; else the start."""
    text = filled(text)
    lines = F.transform(F.split(text, "\n"), _unmarked)
    decided = F.get(F.filter(lines, lambda x: (F.length(x) >= 15) & hits(x, *V.DECISION_VERBS)), F.lit(0))
    plain = F.get(F.filter(lines, lambda x: (F.length(x) >= 20) & ~hits(x, V.PREAMBLE[0].replace("^", "\\A"), "i")), F.lit(0))
    return F.coalesce(F.substring(decided, 1, most), F.substring(plain, 1, most), strip(F.substring(text, 1, most)))


def size_text(n: Column) -> Column:
    n = n.cast("double")
    out = F.format_string("%.1fTB", F.bround(n / 1024.0**4, 1))
    for k, unit in reversed(list(enumerate(("B", "KB", "MB", "GB")))):
        out = F.when(n / 1024.0**k < 1024, F.format_string(f"%.1f{unit}", F.bround(n / 1024.0**k, 1))).otherwise(out)
    return out


def time_text(seconds: Column) -> Column:
    s = seconds.cast("double")
    m = F.floor(s / 60)
    rest = F.floor(s % 60)
    return F.when(s < 60, F.format_string("%.1fs", F.bround(s, 1))).when(m < 60, F.format_string("%dm%02ds", m, rest)).otherwise(F.format_string("%dh%02dm%02ds", F.floor(m / 60), m % 60, rest))


def cache_key(content: Column, version: str) -> Column:
    """The digest of a file's bytes and the version of the rules that read it."""
    return F.concat(F.md5(content), F.lit("_" + version))


def rate_limit(text: Column) -> Column:
    """struct<hour, minute, half, zone> of a `resets 3:30pm (Zone)` notice, null without one."""
    p = r"resets?\s+(?:at\s+)?(\d{1,2})(?::(\d{2}))?\s*(am|pm)(?:\s*\(([^)]+)\))?"
    g = [first(filled(text), p, "i", k) for k in (1, 2, 3, 4)]
    return F.when(hits(filled(text), p, "i"), F.struct(g[0].try_cast("int").alias("hour"), F.coalesce(g[1].try_cast("int"), F.lit(0)).alias("minute"), F.lower(g[2]).alias("half"), F.nullif(g[3], F.lit("")).alias("zone")))


def wait_seconds(notice: Column, now: Column) -> Column:
    """Seconds until the noticed hour next comes."""
    hour = F.pmod(notice["hour"], F.lit(12)) + F.when(notice["half"] == "pm", 12).otherwise(0)
    target = hour * 3600 + notice["minute"] * 60
    left = target - (F.hour(now) * 3600 + F.minute(now) * 60 + F.second(now))
    return F.when(left <= 0, left + 86400).otherwise(left)
