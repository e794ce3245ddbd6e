"""Template residue and contentless pages, by delimiter grammars and the context they stand in."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptloom.llm.factors import Finder, alternatives
from conceptloom.llm.messages import PARTS, message_kind, possible

# --- Slots: one grammar for each kind of delimiter. NAME is an identifier of two characters or more, in any script.
NAME = r"(?:[^\W\d]|[$@])[\w.$\u0900-\u0963-]*[\w\u0900-\u0963]"
SLOTS = {
    "double brace": rf"\{{\{{\{{?\s*[#/^&!>]?\s*{NAME}(?:[ |:][^{{}}\n]*)?\s*\}}?\}}\}}",
    "block tag": r"\{%-?\s*[A-Za-z][^%\n]*%\}",
    "server tag": rf"<%[=-]?\s*{NAME}[^%\n]*%>|<\?(?:php|=)?\s*(?:echo\s+)?\$?{NAME}[^?\n]*\?>",
    "dollar brace": rf"\$\{{{NAME}\}}|\{{\${NAME}\}}|#\{{{NAME}\}}",
    "brace": rf"(?<![\\\w{{}}$#%^]){{{NAME}}}(?![}}{{])",
    "merge tag": rf"\*\|{NAME}\|\*|\|\*{NAME}\*\|",
    "percent": r"%\([^\W\d]\w*\)[sdf]\b|(?<![\w%])(?:%%[^\W\d][\w.]*%%|%[^\W\d][\w.]*[^\W\d]%)(?![\w%])",
    "at": rf"@@{NAME}@@",
    "colon": rf"(?<![\w:])::{NAME}::",
    "underscore": r"(?<!\w)__[^\W\d_][\w.]*?[^\W\d_]__(?!\w)",
    "angle": rf"<<{NAME}>>|<[^\W\d][\w.]*\w>",
    "bracket name": r"\[\[?[A-Za-z_][\w.]*\w\]\]?|\[[A-Z][A-Z]+(?: [A-Z]{2,}){1,4}\]|<[A-Z][A-Z]+(?: [A-Z]{2,}){1,4}>",
    "order": r"(?i:\[\[?(?:[^\[\]\n]*\b)?(?:insert|your|placeholder|to add|to be \w+|tbd|tba|todo|fill in|here goes|einfügen|ausfüllen|ergänzen|à compléter|à remplir|insérer|insertar|completar|rellenar|inserir|preencher)(?:\b[^\[\]\n]*)?\]\]?|\[[^\[\]\n]{0,20}(?:待补|填写|插入|भरें|जोड़ें)[^\[\]\n]{0,20}\]|\((?:insert|enter your|einfügen|insérer|insertar|inserir):? [\w. ]{2,40}\))",
    "blank": r"\([^()\n]{3,60}\)_{3,}|(?m:^[\w ]{2,30}: ?_{4,}\s*$)|(?m:^(?i:dear|hello|hi|liebe[rs]?|sehr geehrte[rs]?|chère?|bonjour|querid[oa]|estimad[oa]|car[oa]|olá|प्रिय|亲爱的) *_{3,})",
    "value": r"\[object Object\]|\bNaN ?%|(?m:^\s*undefined\s*$)|\b(?:Dear|Hello|Hi|Unit:?|[Cc]ourse|lesson on|learn how|Definition of|See also:|by|with) undefined\b",
    "format": r"(?<![\w%])%[sd](?!\w)|(?<![{\\\w^_])(?<!\}, )\{\d\}(?!\}|, ?\{)",
}
_SLOT = re.compile("|".join(f"(?P<g{i}>{p})" for i, p in enumerate(SLOTS.values())))
_MAYBE_SLOT = re.compile(r"[{<%@$]|\*\||\|\*|___|\[(?!\d+:\d)|#\{|__|::|undefined|NaN|\((?i:insert|enter|einf|ins[eé]r)")
_CODE = re.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)|`[^`\n]+`|<(code|pre)\b.*?</\1>", re.S)
_SENTENCE = re.compile(r"[^\n]+?(?:[.!?;。！？；।](?=\s|$)|$)|[^\n。！？；।]+[。！？；।]", re.M)

# Names in angle brackets that are mark-up, and bracketed notes of transcripts and editors.
TAGS = set("a abbr article aside audio b blockquote body br button caption cite code col dd del details div dl dt em figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark math meta nav object ol option p pre q s samp script section select small source span strong style sub summary sup svg table tbody td textarea tfoot th thead title tr tt u ul var video".split()) - {"summary", "source", "title"}
NOTES = set("sic edit note notes music applause laughs laughter inaudible silence pause noise crosstalk citation abridged emphasis redacted audio video end start".split())
DUNDER = set("init main name file doc all dict class str repr call len iter next enter exit new version".split())

# What speaks about slots, errors or scripts instead of being one.
_ABOUT = re.compile(
    r"(?i)\b(?:such as|templates?|placeholders?|slots?|syntax|formats?|printf|variables?|arguments?|notation|index|indices|interval|denotes?|stands? for|means|is written|is replaced|is called|"
    r"(?:let [a-z](?= ?=))|languages?|exercises?|programming|compiler|for example|for instance|e\.g|zum beispiel|beispielsweise|par exemple|por ejemplo|por exemplo|vorlage|platzhalter|modèle de|plantilla|modelo de|"
    r"we class|class them|protocol|when no|explains?|beginners?|compares?)\b|例如|模板|占位|उदाहरण"
)

# What speaks about slots: words of templating, and what goes with them when they explain; formulas have words and signs of their own.
_TEMPLATING = re.compile(
    r"(?i)\b(?:templates?|templating|placeholders?|slots?|syntax|delimiters?|printf|variables?|arguments?|compiler|programming|vorlagen?|platzhalters?|modèles?|plantillas?|modelos?|variablen?)\b|模板|占位|变量|टेम्पलेट"
)
_EXPLAINS = re.compile(
    r"(?i)\b(?:such as|like|formats?|notation|denotes?|stands? for|means|marks?|written|is replaced|are replaced|is called|languages?|for example|for instance|e\.g|zum beispiel|beispielsweise|wie|ersetzt|par exemple|comme|remplacée?|por ejemplo|por exemplo|como|"
    r"we class|class them|explains?|compares?)\b|例如|替换|उदाहरण"
)
_FORMULA = re.compile(r"(?i)\b(?:let [a-z](?= ?=)|notation|index|indices|interval|denotes?|sets?)\b(?=.*[=^\\∈≤≥+|])|[=^\\∈≤≥+|].*\b(?:notation|index|indices|interval|denotes?|sets?)\b")
_QUOTED = "\"'“”„«»‘’「」"

# --- Whole texts: cues of notices, errors and demands, in the languages of the corpus.
_NOTICE = re.compile(
    r"(?i)coming soon|not (?:been|yet) (?:written|published|available)|under construction|to be (?:added|written|announced|completed|continued)|\btodo\b|write this section|content (?:is )?(?:pending|missing|to follow|will follow)|check back|no content|(?:section|page|lesson|unit) is (?:still )?empty|"
    r"noch leer|inhalt folgt|in kürze|im aufbau|in bearbeitung|folgt demnächst|contenido pendiente|vuelva a visitar|próximamente|en construcción|aún no (?:está|hay)|à venir|bientôt disponible|en construction|pas encore (?:rédigé|disponible|écrit)|contenu en attente|em breve|em construção|conteúdo pendente|ainda não (?:está|há|foi)|"
    r"जल्द|निर्माणाधीन|अभी (?:खाली|उपलब्ध नहीं)|建设中|敬请期待|即将(?:推出|上线)|待补充|尚未|内容待"
)
_ERROR = re.compile(
    r"(?i)(?:could|can|did|was) ?not (?:be )?(?:load|connect|f[io]u?nd|display|open|locat|reach|answer|render|process|establish)|(?:couldn|can|didn)['’]t (?:be )?(?:load|connect|find|display|open|locat|reach)|unable to|failed to|\bnot found\b|no longer (?:here|available|exists?)|(?:been|was) (?:moved|removed|deleted)|down for maintenance|unexpected (?:problem|error)|empty (?:reply|response)|"
    r"can ?not (?:start|run|work|be (?:shown|opened|displayed))|timed? ?out|(?:access|permission) (?:is )?denied|permission to|session (?:has )?expired|(?:sign|log) ?in (?:again|to continue)|too many requests|rate.?limit|retry after|bad gateway|bad request|internal server error|service unavailable|gateway time|\bforbidden\b|unauthori[sz]ed|try again|go back to the|report this|request id|contact the|traceback|^\s*file \"[^\"]+\", line|"
    r"(?:error|exception): ?['\"\w]|\bfatal\b|something went wrong|page is gone|\boops\b|^\s*(?:error|http|warning|sorry)\b|\bloading\b|please wait|checking your browser|"
    r"nicht (?:gefunden|(?:mehr )?verfügbar|geladen)|zugriff verweigert|fehler (?:\d|ist|beim|aufgetreten)|ein fehler|später (?:erneut|noch)|sitzung (?:ist )?abgelaufen|introuvable|n['’]existe (?:plus|pas)|(?:été|est) (?:déplacée?|supprimée?)|accès refusé|erreur|réessaye|session (?:a )?expiré|une erreur|"
    r"algo salió mal|no (?:pudimos|se pudo|se encontr|existe)|no encontrada|acceso denegado|inténte|código \d|(?:la )?sesión (?:ha )?(?:caducado|expirado)|algo (?:deu|correu) (?:errado|mal)|não (?:foi possível|encontrad|existe|conseguimos)|acesso negado|tente (?:novamente|de novo)|sessão (?:expirou|expirada)|\berro \d|"
    r"उपलब्ध नहीं|त्रुटि|फिर प्रयास|नहीं मिला|अनुमति नहीं|लोड नहीं|不存在|被删除|错误代码|返回首页|无法(?:加载|访问|显示)|拒绝访问|访问被拒|稍后(?:再|重)试|找不到|出错|已过期"
)
_SCRIPT = re.compile(
    r"(?i)\A(?=.*(?:java ?script|\bscript(?:s|ing)?\b|\bcookies?\b|\bjs\b|स्क्रिप्ट|कुकी|脚本))"
    r".*(?:enabl|allow|activ|aktiv|habilit|ativ[ae]|permit|turn|switch|need|must|requir|disable|blocks?\b|blocker|support|sans |without|accept|akzept|erforderlich|notwendig|nécessaire|necesari|necessári|सक्षम|चालू|启用|允许|开启)"
)
_NEUTRAL = re.compile(r"(?i)^\W*(?:home|courses|help|contact|menu|search|login)(?: \| \w+)*\W*$|^\W*\(?(?:unit|lab|ref|code|viewer build|build|lesson|id|no)\.? ?#?[\w-]*\)?\W*$|^[\W\d_]*$|^\S+/\d+$")
_FILLER = re.compile(r"(?i)lorem ipsum|dolor sit amet|consectetur adipi|\btext goes here|\bblindtext\b|your (?:\w+ ){1,3}(?:goes )?here|\b(?:sample|dummy|placeholder|filler) (?:heading|text|title|caption)|caption here|heading level|\bblah\b|\b(?:x{2,} ?){3,}|asdf|qwert[yz]|hier steht text|texto de (?:ejemplo|exemplo|relleno)|texte? (?:factice|d['’]exemple)|占位(?:符|文字)|示例文字")
_CUES = (("filler", _FILLER), ("script demand", _SCRIPT), ("notice", _NOTICE), ("error", _ERROR))
# One pass over a sentence tells which patterns can match at all: a bit for each part of messages, then for each alternative of a cue.
_EACH = [(kind, one) for kind, cue in _CUES for one in alternatives(cue)]
_CAN = Finder([*PARTS.values(), *[one for _, one in _EACH]])
_PART_BITS = (1 << len(PARTS)) - 1
_WORD = re.compile(r"[぀-ヿ㐀-䶿一-鿿]|(?:[^\W\d_぀-ヿ㐀-䶿一-鿿]|[ऀ-ॣ])+")
# Commonest words of the corpus languages written in Latin script; a real text of some length has some of them.
FUNCTION_WORDS = set(
    "the of and to in a is that it for as was with on are by this be at from or an which not but you we have can if does "
    "der die das und ist von zu den mit sich des auf für nicht ein eine im dem als auch es an werden aus er hat dass bei bis wenn wir "
    "le la les de des du et est un une que qui dans pour pas sur au par plus ce se ne en avec si nous l d c "
    "el los las y del al por con para una su lo como más pero o sin se esta es "
    "o os as do da dos das em um uma não no na que por mais com para se ao e é sem até".split()
)
#: Words from which the shares are judged; largest share of different words in a repeated filler, of common words in gibberish; share of
#: the text that cues must hold.
LEAST_WORDS, REPEATED, COMMON, HELD = 12, 0.15, 0.1, 0.6
#: Words of a line of navigation at most.
NAVIGATION = 20


def _plain(name: str) -> str:
    return re.sub(r"[^\w.]", "", name)


def _discussed(line: str, slots: list[tuple[str, str]], with_code: bool) -> bool:
    """Whether a sentence is about its slots: it has words of templating and further evidence (it explains, quotes them, has
    several of those words, or stands in a text with code), quotes them to explain them, or is a formula of braces and brackets."""
    rest = _SLOT.sub(" ", line)
    words = {w.lower() for w in _TEMPLATING.findall(rest)}
    quoted = all(line[max(0, i - 1) : i] in _QUOTED and line[i + len(s) : i + len(s) + 1] in _QUOTED for _, s in slots if (i := line.find(s)) > 0 and i + len(s) < len(line)) and any(0 < line.find(s) < len(line) - len(s) for _, s in slots)
    explains = bool(_EXPLAINS.search(rest))
    if words and (explains or quoted or with_code or len(words) > 1) or quoted and explains:
        return True
    return all(k in ("brace", "bracket name", "angle", "format") for k, _ in slots) and bool(_FORMULA.search(rest))


def open_slots(text: str) -> list[tuple[str, str]]:
    """(kind, slot) of the slots left open. Code is taken out; a slot in a sentence that is about slots or formulas
    is discussed and not open, and neither are further ones of the same writing in that text."""
    if not _MAYBE_SLOT.search(text):
        return []
    text, with_code = _CODE.subn(" ", text)
    kinds = list(SLOTS)
    found, discussed, alone = [], set(), Counter()
    for s in _SENTENCE.finditer(text):
        line = s.group()
        if not _MAYBE_SLOT.search(line):
            continue
        slots = []
        for m in _SLOT.finditer(line):
            kind, slot = kinds[m.lastindex - 1 if m.lastgroup is None else int(m.lastgroup[1:])], m.group()
            name = _plain(slot)
            if kind == "angle" and not slot.startswith("<<") and (name.lower() in TAGS or f"</{name}" in text):
                continue
            if kind == "underscore" and name.strip("_").lower() in DUNDER:
                continue
            if kind == "bracket name" and (name.lower() in NOTES or re.fullmatch(r"[A-Z][a-z]+\d{2,4}[a-z]?", name)):
                continue
            slots.append((kind, slot, line.strip() == slot))
        if slots and _discussed(line, [x[:2] for x in slots], bool(with_code)):
            discussed.update(slot for _, slot, _ in slots)
        else:
            found += slots
            alone.update(slot for _, slot, _ in slots)
    return [(k, s) for k, s, by_itself in found if s not in discussed and not (k == "bracket name" and s.lower() == s and not re.search(r"[_.]", s) and not by_itself and alone[s] < 2 and len(found) < 2)]


def sentence_kind(s: str, weight: int) -> str | None:
    """What a sentence is a cue for: by the fixed cues, else by the grammar of messages; one that is about such things is none."""
    may = _CAN.bits(s.lower())
    cues, parts = may >> len(PARTS), may & _PART_BITS
    if not (cues or possible(parts)) or (_ABOUT.search(s) and not s.startswith("Traceback")):
        return None
    while cues:
        kind, one = _EACH[(cues & -cues).bit_length() - 1]
        if one.search(s):
            return kind
        cues &= cues - 1
    return message_kind(s, weight, parts) if possible(parts) else None


def whole_text_reason(text: str) -> str | None:
    """'filler', 'notice', 'error' or 'script demand' if the text as a whole is that, else None."""
    low = text.lower()
    words = _WORD.findall(low)
    n, different = len(words), len(set(words))
    if n >= LEAST_WORDS:
        if different <= min(10, max(6, REPEATED * n)):
            return "filler"
        if n >= 2 * LEAST_WORDS and sum(w in FUNCTION_WORDS for w in words) <= COMMON * n and all("a" <= w[0] <= "z" and len(w) > 1 for w in words):
            return "filler"
    held, size, other = Counter(), 0, 0
    for m in _SENTENCE.finditer(text):
        s = m.group().strip()
        weight = len(_WORD.findall(s))
        if not s or (weight <= NAVIGATION and _NEUTRAL.search(s)):
            continue
        size += weight
        kind = sentence_kind(s, weight)
        if kind:
            held[kind] += weight
        else:
            other += weight
            if other > (1 - HELD) * n:  # what is left can't reach the share any more
                return None
    if size and sum(held.values()) >= HELD * size:
        return held.most_common(1)[0][0]
    return None


def contentless(documents: DataFrame) -> DataFrame:
    """Documents (doc_id, text) to leave out: (doc_id, reason, n_slots, slot).

    reason is 'slot' if something meant to be filled in was left open (n_slots of them, slot the first), else what the text
    as a whole is: 'filler', 'notice', 'error' or 'script demand'. A document that has such things as its subject, in code,
    formulas or prose, does not come out: code is taken out, sentences about templates, formats or protocols don't
    count, and whole texts are judged by the share of words in sentences with a cue. Null and empty texts do not come
    out; every row is judged on its own, so copies and repeat rows all come out. One pass, nothing is shuffled.
    """

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                slots = open_slots(text)
                if slots:
                    out.append((doc_id, "slot", len(slots), slots[0][1]))
                elif reason := whole_text_reason(text):
                    out.append((doc_id, reason, 0, None))
            yield pd.DataFrame(out, columns=["doc_id", "reason", "n_slots", "slot"])

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").filter(F.col("text") != "").mapInPandas(judge, f"doc_id {kind}, reason string, n_slots int, slot string")
