"""A grammar of messages that stand in place of content: who is spoken to, what is missing, and what is asked for.

A sentence of such a message combines parts that sentences of lessons hardly combine: a thing of delivery (page, file,
lesson), a part of the system (server, browser), the visitor, a lack (a state of absence, or a negated verb of presence), a
time of waiting, and an action asked of the visitor. Words are stems, so inflections count; no whole phrase is listed.
"""

from __future__ import annotations

import re

# Stems of the parts in English, German, French, Spanish, Portuguese, Hindi and Chinese.
THINGS = [
    r"(?:web)?pages?\b(?! \d)|(?:web)?sites?\b|website|lessons?\b|sections?\b|chapters?\b|contents?\b|materials?\b|resources?\b|files?\b|documents?\b|articles?\b|videos?\b|courses?\b|modules?\b|features?\b|services?\b|descriptions?\b|director(?:y|ies)\b|quiz|transcripts?\b",
    r"seiten?\b(?! \d)|webseite|lektion|abschnitt|kapitel|inhalte?\b|datei|dokument|artikel|kurs|dienst|angebot",
    r"leçons?\b|chapitres?\b|contenus?\b|fichiers?\b|cours\b|ressources?\b",
    r"páginas?\b(?! \d)|sitio|lección|lecciones|sección|capítulos?\b|contenidos?\b|archivos?\b|documentos?\b|artículo|cursos?\b|servicio|recursos?\b",
    r"aulas?\b|lição|lições|seção|secção|conteúdos?\b|arquivos?\b|ficheiros?\b|artigos?\b|serviço",
    r"पृष्ठ|पेज|पाठ(?![्ा-ौ])|सामग्री|फ़ाइल|फाइल|अनुभाग|अध्याय|साइट",
    r"页面|网页|网站|文件|课程|章节|内容|资源|文档|本节|本课",
]
VAGUE = [
    r"connections?\b|access\b|requests?\b|requested\b|links?\b|sessions?\b|units?\b|images?\b|results?\b|quer(?:y|ies)\b|addresses|permission|quota|downloads?\b|accounts?\b|playback|viewer|request(?:ed|s)?\b",
    r"verbindung|zugriff|zugang|anfrage|angefordert\w*|sitzung|berechtigung|konto|bild\b",
    r"connexion|accès|requête|demandée?s?\b|session|autorisation|compte|liens?\b",
    r"conexión|acceso|solicitud|solicitad[oa]s?\b|petición|sesión|permiso|cuenta|enlace",
    r"ligação|conexão|acesso|pedido|solicitad[oa]s?\b|sessão|permissão|conta\b",
    r"कनेक्शन|अनुमति|अनुरोध|सत्र|खाता|लिंक",
    r"连接|权限|请求|会话|链接|账号|访问",
]
SYSTEM = [
    r"servers?\b|browsers?\b|cookies?\b|java ?script|scripts?\b|scripting|urls?\b|https?\b|administrators?\b|webmaster|databases?\b|ip address|dns\b|proxy|firewall|captcha|security check|log ?in\b|sign ?in\b|password|robots?\b|human\b",
    r"browsers?\b|skripte?\b|datenbank|anmeld\w+|administrator",
    r"serveurs?\b|navigateurs?\b|base de données|administrateur|scripts?\b",
    r"servidor(?:es)?\b|navegador(?:es)?\b|base de datos|administrador",
    r"servidor(?:es)?\b|navegador(?:es)?\b|base de dados|administrador",
    r"सर्वर|ब्राउज़र|ब्राउजर|कुकी|स्क्रिप्ट",
    r"服务器|浏览器|脚本|数据库|管理员",
]
VISITOR = [
    r"you(?:r|rs)?\b|please\b|we\b|we['’]\w+|our\b|us\b", r"sie\b|ihre?[nmrs]?\b|ihnen\b|bitte\b|wir\b|unser\w*", r"vous\b|v(?:otre|os)\b|merci\b|veuillez\b|nous\b",
    r"usted(?:es)?\b|su\b|sus\b|por favor\b|tiene\b|puede\b|nuestro", r"você|seus?\b|sua\b|por favor\b|tem\b|pode\b|nosso", r"आप(?:का|की|के|को|ने)?(?![ऀ-ॣ])|कृपया|हम(?:ारे|ारा|ारी)?(?![ऀ-ॣ])", r"您|请|我们|抱歉",
]
ABSENT = [
    r"unavailable|missing\b|moved\b|removed\b|deleted\b|expired\b|blocked\b|denied\b|rejected\b|refused\b|forbidden\b|disabled\b|offline\b|broken\b|corrupt\w*|private\b|blank\b|empty\b|pending\b|fail(?:s|ed|ure)?\b|overloaded\b|interrupted\b|lost\b|reset\b|timed out|time-?out|out of date|outdated|exceeded|reached your|restricted\b|suspended\b|unexpected\b|internal (?:error|problem)|trouble\b|went wrong|under construction|maintenance|scheduled work|being (?:prepared|written|updated|revised)|in preparation",
    r"verschoben|gelöscht|entfernt\b|abgelaufen|gesperrt|blockier\w+|verweigert|fehlgeschlagen|unterbrochen|nicht verfügbar|leer\b|überlastet|wartung\w*|überarbeitet|in vorbereitung|unvollständig|deaktiviert",
    r"déplacée?s?\b|supprimée?s?\b|retirée?s?\b|expirée?\b|bloqu\w+|refusée?\b|échou\w+|interrompue?\b|indisponible|vide\b|maintenance|en préparation|désactivée?\b|introuvable|perdue?\b",
    r"movid[oa]\b|eliminad[oa]\b|borrad[oa]\b|caducad[oa]|bloquead[oa]|denegad[oa]|fall(?:ó|ado)|perdid[oa]|interrumpid[oa]|vacía?o?\b|mantenimiento|en preparación|desactivad[oa]|no disponible",
    r"movid[oa]\b|removid[oa]\b|apagad[oa]\b|excluíd[oa]|expirou|bloquead[oa]|negad[oa]\b|falhou|perdid[oa]|interrompid[oa]|vazi[oa]\b|manutenção|em preparação|desativad[oa]|indisponível",
    r"टूट|हटा (?:दिय|दी)|विफल|अवरुद्ध|खाली|समाप्त हो|अनुपलब्ध|रखरखाव|तैयार की जा",
    r"失败|已被?(?:移动|删除|移除|禁止|过期|拒绝)|中断|断开|为空|维护|准备中|建设中|编写中|不可用|过期|超时|受限",
]
NOT = [
    r"not\b|n['’]t\b|never\b|no\b|none\b|nothing\b|cannot\b|unable to", r"nicht\b|keine?[nrms]?\b|nie\b", r"ne\b|n['’]|pas\b|aucune?\b|impossible",
    r"no\b|ningun\w*|nunca\b|imposible|ya no\b", r"não\b|nenhum\w*|nunca\b|impossível", r"नहीं|ना हो", r"不|没有?|未|无",
]
PRESENT = [
    r"availab\w+|found\b|find\b|exist\w*|publish\w*|ready\b|written\b|display\w*|shown?\b|load(?:ed|ing)?\b|open(?:ed)?\b|reach\w*|locat\w+|access\w*|view(?:ed)?\b|connect\w*|render\w*|process\w*|complete[d]?\b|respond\w*|retriev\w*|support\w*|allow\w*|permi\w+|authori\w+|provided\b|returned\b|here\b|posted\b|uploaded\b|added\b|working\b|grant\w*",
    r"verfügbar|verfügung|gefunden|existier\w*|veröffentlicht|bereit\b|fertig|geladen|geöffnet|erreich\w+|angezeigt|anzeigen|antwortet|berechtigt|berechtigung|unterstützt|erlaub\w+|vorhanden",
    r"disponible|trouv\w+|exist\w+|publiée?|prête?\b|charg\w+|ouvr\w+|accessible|affich\w+|répond\w*|autoris\w+|permi[st]\w*",
    r"disponible|encontr\w+|existe\w*|publicad[oa]|list[oa]\b|carg\w+|abr\w+|acces\w+|mostr\w+|respond\w+|permiso|autoriza\w+|está en\b",
    r"disponível|encontr\w+|existe\w*|publicad[oa]|pront[oa]\b|carreg\w+|abr\w+|aceder|acess\w+|mostr\w+|respond\w+|permissão|autoriza\w+",
    r"मौजूद|उपलब्ध|मिल|तैयार|प्रकाशित|खुल|लोड|अनुमति",
    r"存在|找到|可用|发布|打开|加载|访问|显示|支持|权限|响应|完成|上线",
]
WAIT = [
    r"soon\b|later\b|shortly\b|yet\b|(?:try|log|sign|come|start|load\w*|request\w*) (?:\w+ )?again\b|in a (?:few|couple)|(?:few|some) minutes|minutes?\b|moment\b|back\b", r"später|bald\b|demnächst|in kürze|noch nicht|noch einmal|erneut|derzeit|noch (?:leer|überarbeitet|in)",
    r"plus tard|bientôt|prochainement|momentanément|pas encore|à nouveau|instant", r"más tarde|pronto\b|próximamente|todavía no|aún no|de nuevo|momento", r"mais tarde|em breve|ainda não|novamente|de novo|momento", r"बाद में|जल्द|अभी|फिर से|दोबारा", r"稍后|即将|尚未|之后|再试|重试|正在",
]
ACTION = [
    r"try\b|retry\b|reload\b|refresh\b|check back|come back|contact\b|consult\b|ask your|verify\b|confirm\b|log ?in\b|sign ?in\b|enable\b|turned? on|switch(?:ed)? (?:it )?on|activate\b|allow\b|update it|update your|upgrade\b|wait\b|complete the|solve the|return to|go back|must be requested|needs?\b",
    r"versuchen sie|aktivieren|laden sie|aktualisieren|kontaktieren|wenden sie|melden sie|prüfen sie|gehen sie|muss|müssen", r"réessay\w+|actualis\w+|activez|activer|contactez|connectez|vérifiez|revenir|revenez|doit\b",
    r"inténte\w*|intente\w*|vuelva\b|actualice|active\b|activar|contacte|verifique|debe\b|regrese", r"tente\b|volte\b|atualize|ative\b|ativar|ativad\w+|contacte|verifique|precisa|deve\b", r"कोशिश करें|प्रयास करें|सक्षम करें|चालू करें|संपर्क करें|ताज़ा करें", r"刷新|重试|启用|开启|联系|登录|返回|检查|验证",
]
#: Parts as patterns, in the order of the bits by which it is said which of them can match.
PARTS = {
    name: re.compile("|".join(f"(?:{x if any('ऀ' <= c <= 'ॣ' or c > '㐀' for c in x) else rf'(?<![^\W_])(?:{x})'})" for x in stems))
    for name, stems in (("absent", ABSENT), ("wait", WAIT), ("action", ACTION), ("present", PRESENT), ("thing", THINGS), ("vague", VAGUE), ("system", SYSTEM), ("visitor", VISITOR))
}
_NAMES = list(PARTS)
_NOT = re.compile("|".join(f"(?:{x})" if i > 4 else rf"(?<![^\W_])(?:{x})" for i, x in enumerate(NOT)) + r"|n['’]t\b")
_SCRIPTS = re.compile(r"script|skript|cookie|स्क्रिप्ट|कुकी|脚本")
#: Longer sentences explain something. What is absent stands so near to what says so (characters), a negation so near to its verb.
MOST_WORDS, NEAR_THING, NEAR_VERB = 40, 60, 40


def possible(may: int) -> bool:
    """Whether bits of PARTS can make a message: something is absent, awaited or asked for, and there is someone or something."""
    return bool(may & 0b1111) and bool(may & 0b11110000)


def message_kind(sentence: str, n_words: int, may: int = 255) -> str | None:
    """'notice' (what is awaited), 'script demand' or 'error' if the sentence is built like a message in place of content."""
    if n_words > MOST_WORDS:
        return None
    low = sentence.lower()
    spans: dict[str, list[tuple[int, int]]] = {}

    def at(name: str) -> list[tuple[int, int]]:
        if name not in spans:
            spans[name] = [m.span() for m in PARTS[name].finditer(low)] if may >> _NAMES.index(name) & 1 else []
        return spans[name]

    near = lambda x, y, most: any(a - d <= most and c - b <= most for a, b in x for c, d in y)
    absent, wait, action = list(at("absent")), bool(at("wait")), bool(at("action"))
    if at("present") and (negations := [m.span() for m in _NOT.finditer(low)]):
        absent += [(min(a, c), max(b, d)) for a, b in negations for c, d in at("present") if near([(a, b)], [(c, d)], NEAR_VERB)]
    if not (absent or wait or action):
        return None
    visitor, system, thing = bool(at("visitor")), at("system"), at("thing")
    vague = at("vague") if not thing and (visitor or system or wait or n_words <= 7) else []
    about = thing + system + vague
    lacking = bool(absent) and near(absent, about, NEAR_THING)
    # Something of delivery is absent; or the visitor is asked to wait or act for it; an absence alone is any lesson's.
    awaited = wait and (about or visitor and action) and (lacking or visitor or action or thing and n_words <= 12)
    if lacking or awaited or (action and visitor and about):
        if system and action and not absent and _SCRIPTS.search(low):
            return "script demand"
        return "notice" if wait and not system and not action else "error"
    return None
