"""8. Quality rules, line first.

Every line is judged by itself: navigation (many ``|`` or ``»`` separators, or a menu word alone), boilerplate (stock
phrases of sites) and punctuation (a short line without a closing mark, too many symbols, runs of ``!`` and ``?``).
Failing lines are removed; a document that loses more than ``max_lost`` of its characters this way is rejected.

Defined results: blank lines neither fail nor count; a null text gives nulls and keep = false; a text without a
character to judge (empty or blank) keeps its text and has lost = 0 but keep = false; repeated rows give repeated
rows; ``kept_text`` joins the remaining lines by newlines; columns other than doc_id and text are ignored; an empty
table gives an empty result. The rules are plain column expressions, one scan without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import util

MAX_LOST = 0.5
#: Stock phrases of sites and words of menus in the languages of the corpus (English, German, French, Spanish).
BOILERPLATE = (
    "all rights reserved|cookie (policy|settings|consent)|we use cookies|privacy policy|terms of (use|service)|subscribe (to|now)|sign (in|up)( |$)|"
    "log ?in( |$)|click here|enable javascript|powered by |lorem ipsum|skip to (main )?content|share (this|on) |copyright (©|[(]c[)]|[0-9]{4})|"
    "alle rechte vorbehalten|datenschutzerklärung|wir verwenden cookies|nutzungsbedingungen|newsletter abonnieren|hier klicken|zum inhalt springen|"
    "tous droits réservés|politique de confidentialité|nous utilisons des cookies|conditions d.utilisation|cliquez ici|aller au contenu|"
    "todos los derechos reservados|política de privacidad|utilizamos cookies|condiciones de uso|haga clic aquí|saltar al contenido"
)
MENU = (
    "^(home|menu|search|about( us)?|contact( us)?|next|previous|back( to top)?|read more|login|register|help|sitemap|startseite|menü|suche|kontakt|weiter|"
    "zurück|mehr lesen|anmelden|impressum|accueil|recherche|suivant|précédent|lire la suite|connexion|inicio|buscar|contacto|siguiente|anterior|leer más)$"
)


def _rules(boilerplate: str, menu: str) -> dict[str, str]:
    """SQL text of each rule over a trimmed line t."""
    chars = lambda pattern: f"(length(t) - length(regexp_replace(t, r'{pattern}', '')))"
    runs = lambda pattern: f"length(regexp_replace(regexp_replace(t, r'{pattern}', '\u0001'), r'[^\u0001]', ''))"
    navigation = f"({chars('[|»]')} >= 3 or lower(t) rlike r'{menu}')"
    closing = "(t rlike r'[.!?…:;)»”’。！？]$' or right(t, 1) in (chr(34), chr(39)))"
    symbol = "[^A-Za-z0-9\\x{80}-\\x{10FFFF} \\t]"
    words = "[^ \\t]+"
    punctuation = f"((not {closing} and {runs(words)} < 12) or {chars(symbol)} > 0.25 * length(t) or {runs('[!?][!?]+')} >= 3)"
    return {"navigation": navigation, "boilerplate": f"lower(t) rlike r'{boilerplate}'", "punctuation": punctuation}


_TRIMMED = "regexp_replace(l, r'^[ \\t\\r]+|[ \\t\\r]+$', '')"


def clean_lines(docs: DataFrame, max_lost: float = MAX_LOST, boilerplate: str = BOILERPLATE, menu: str = MENU) -> DataFrame:
    """doc_id, kept_text, n_lines, n_navigation, n_boilerplate, n_punctuation, lost, keep of every document."""
    rule = _rules(boilerplate, menu)
    # the first rule that a line fails: 0 none, 1 navigation, 2 boilerplate, 3 punctuation, -1 blank
    verdict = f"transform(transform(split(text, '\n'), l -> {_TRIMMED}), t -> case when t = '' then -1 when {rule['navigation']} then 1 when {rule['boilerplate']} then 2 when {rule['punctuation']} then 3 else 0 end)"
    judged = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("lines", F.expr("split(text, '\n')")).withColumn("verdict", F.expr(verdict))
    n = lambda v: F.expr(f"cast(size(filter(verdict, v -> v = {v})) as bigint)")
    out = judged.select(
        "doc_id",
        F.expr("array_join(filter(lines, (l, i) -> verdict[i] <= 0), '\n')").alias("kept_text"),
        F.expr("case when text is not null then cast(size(filter(verdict, v -> v >= 0)) as bigint) end").alias("n_lines"),
        *[F.when(F.col("text").isNotNull(), n(v)).alias(f"n_{name}") for v, name in ((1, "navigation"), (2, "boilerplate"), (3, "punctuation"))],
        F.expr("aggregate(lines, 0L, (a, l) -> a + length(l))").alias("all_chars"),
        F.expr("aggregate(filter(lines, (l, i) -> verdict[i] > 0), 0L, (a, l) -> a + length(l))").alias("lost_chars"),
    )
    lost = F.when(F.col("all_chars") > 0, F.round(F.col("lost_chars") / F.col("all_chars"), 6)).when(F.col("all_chars") == 0, F.lit(0.0))
    return out.select("doc_id", "kept_text", "n_lines", "n_navigation", "n_boilerplate", "n_punctuation", lost.alias("lost"), F.coalesce((F.col("n_lines") > 0) & (lost <= max_lost), F.lit(False)).alias("keep"))


def reject(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """The rows of ``docs`` that keep enough, with the text that is left; other columns as they are. Rows are judged
    in place, without a join; the input's names are free."""
    c_row, c_got = util.fresh(docs, "quality_row", "quality_got")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), F.col("text"))
    got = clean_lines(rows, max_lost).where("keep").select(F.col("doc_id").alias(c_row), F.col("kept_text").alias(c_got))
    return got.select(*[F.col(c_got).alias("text") if c == "text" else F.col(f"{c_row}.`{c}`").alias(c) for c in docs.columns])


#: Written by hand, apart from the column expressions.
ORACLE = r"""
with line as (
  select r, i, l, trim(l, chr(32) || chr(9) || chr(13)) as t
  from (select r, unnest(ls) as l, unnest(range(1, len(ls) + 1)) as i
        from (select row_number() over () as r, string_split(text::varchar, chr(10)) as ls from documents))),
judged as (
  select r, i, l,
    case when t = '' then 'blank'
      when len(regexp_extract_all(t, '[|»]')) >= 3
        or lower(t) in ('home', 'menu', 'search', 'about', 'about us', 'contact', 'contact us', 'next', 'previous', 'back', 'back to top', 'read more', 'login',
          'register', 'help', 'sitemap', 'startseite', 'menü', 'suche', 'kontakt', 'weiter', 'zurück', 'mehr lesen', 'anmelden', 'impressum', 'accueil', 'recherche',
          'suivant', 'précédent', 'lire la suite', 'connexion', 'inicio', 'buscar', 'contacto', 'siguiente', 'anterior', 'leer más') then 'navigation'
      when len(list_filter(['all rights reserved', 'cookie policy', 'cookie settings', 'cookie consent', 'we use cookies', 'privacy policy', 'terms of use',
          'terms of service', 'subscribe to', 'subscribe now', 'sign in ', 'sign up ', 'log in ', 'login ', 'click here', 'enable javascript', 'powered by ',
          'lorem ipsum', 'skip to content', 'skip to main content', 'share this ', 'share on ', 'copyright ©', 'copyright (c)', 'alle rechte vorbehalten',
          'datenschutzerklärung', 'wir verwenden cookies', 'nutzungsbedingungen', 'newsletter abonnieren', 'hier klicken', 'zum inhalt springen',
          'tous droits réservés', 'politique de confidentialité', 'nous utilisons des cookies', 'cliquez ici', 'aller au contenu',
          'todos los derechos reservados', 'política de privacidad', 'utilizamos cookies', 'condiciones de uso', 'haga clic aquí', 'saltar al contenido'],
          lambda p: contains(lower(t), p))) > 0
        or len(list_filter(['sign in', 'sign up', 'log in', 'login'], lambda p: ends_with(lower(t), p))) > 0
        or regexp_matches(lower(t), 'copyright [0-9][0-9][0-9][0-9]|conditions d.utilisation') then 'boilerplate'
      when (right(t, 1) not in ('.', '!', '?', '…', ':', ';', ')', '»', '”', '’', '。', '！', '？', chr(34), chr(39))
          and len(list_filter(string_split(replace(t, chr(9), ' '), ' '), lambda w: w <> '')) < 12)
        or len(regexp_extract_all(t, '[\x01-\x08\x0a-\x1f!-/:-@\[-`{-\x7f]')) > 0.25 * length(t)
        or len(regexp_extract_all(t, '[!?][!?]+')) >= 3 then 'punctuation'
      else 'good' end as verdict
  from line),
counted as (
  select r, coalesce(string_agg(l, chr(10) order by i) filter (verdict in ('good', 'blank')), '') as kept_text,
    count(*) filter (verdict <> 'blank') as n_lines, count(*) filter (verdict = 'navigation') as n_navigation,
    count(*) filter (verdict = 'boilerplate') as n_boilerplate, count(*) filter (verdict = 'punctuation') as n_punctuation,
    sum(length(l)) as all_chars, coalesce(sum(length(l)) filter (verdict not in ('good', 'blank')), 0) as lost_chars
  from judged group by r),
shares as (select *, case when all_chars > 0 then round(lost_chars::double / all_chars::double, 6) else 0.0::double end as lost from counted)
select d.doc_id, kept_text, n_lines, n_navigation, n_boilerplate, n_punctuation, lost,
  coalesce(n_lines > 0 and lost <= MAX_LOST, false) as keep
from (select doc_id, row_number() over () as r from documents) d left join shares using (r)"""


def oracle(max_lost: float = MAX_LOST) -> str:
    return ORACLE.replace("MAX_LOST", str(max_lost))
