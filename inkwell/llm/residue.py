"""Problem 8: template residue, filler, error pages and script notices, by a linear classifier.

A text is cut into segments (sentences and lines). What is quoted and what is a program listing is
masked first, so that texts on such things show only the mask; slots of template languages become one
token. A segment's features are its words, pairs and triples, hashed, with its length, that of the
document, and whether it stands alone, first, last, or as the document's title. Weights come from a
logistic regression with an L2 penalty. Its labels are weak: phrases and slots, response status codes at
the begin or end of a segment, and segments made of the words that labelled filler is made of. A document is a case if one of its segments scores over the
threshold. Training sees the labelled segments of all documents, a few of each wording, which stand for all
of it, and a bounded number of wordings, and other segments of a bounded sample of documents. The sources (hosts) of a fifth of it are
held out to validate; the model that is used is then fitted to all of it. All documents are scored, whole.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.session import shared_dir, written
from inkwell.sources.generations import Generations

#: Documents that unlabelled segments for training are taken from, about so many at most.
SAMPLE_DOCS = 10_000
#: Wordings of labelled segments that are trained on, about so many at most, drawn by hash, and segments of each.
WORDINGS = 30_000
OF_WORDING = 50
#: One in so many unlabelled segments of these is a negative example, and every one of up to three words.
NEGATIVES = 5
BITS = 19
#: Least share that a word's filler segments have of all its segments, for it to be a word of filler.
FILLER_SHARE = 0.05
#: Log-odds over which a segment is residue; both classes have equal weight in training, where residue is rare.
THRESHOLD = 1.5

#: Quotations close in their line, however long they are.
_QUOTED = re.compile(r"„[^“”\n]*[“”]|«[^»\n]*»|“[^”\n]*”|`[^`\n]*`|\"[^\"\n]*\"")
_CODE = re.compile(
    r"<noscript\b[^>]*>.*?</noscript>|<script\b[^>]*>.*?</script>|<div\b[^>]*>\s*</div>|<(\w+)>\s*\{\{[^}\n]*\}\}\s*</\1>"
    r"|\b(?:GET|POST|PUT) /\S* -> \d+|\braise \w+\([^)\n]*\)|\bprint\([^)\n]*\)|\bfor \w+ in \w+\(\d*\):|\becho \"[^\"\n]*\"(?: >> \S+)?|\b\w+ = f?\"[^\"\n]*\"",
    re.IGNORECASE)
_LETTER = r"[^\W\d_]"
_CAPITALS = "".join(c for c in map(chr, range(0x10000)) if c.isalpha() and c.isupper())
_NAME = _LETTER + r"[\w.\- ]*"
_SLOT = re.compile(
    r"\{%[^%\n]+%\}(?:\{%[^%\n]+%\})?|\{\{[^{}\n]+\}\}|<%=?[^%\n]+%>|\[%[^%\n]+%\]|\[\[" + _NAME + r"\]\]|<<" + _NAME + r">>|\$\{" + _NAME + r"\}|%%\w{2,}%%|@@\w{2,}@@|%\(\w+\)s"
    r"|(?<![\w$])\$" + _LETTER + r"\w+\$|(?<![\w#])#[" + _CAPITALS + r"]\w+#|(?<!\w)__" + _LETTER + r"\w+__|\{" + _LETTER + r"\w*\}|\[[" + _CAPITALS + "]{2}[" + _CAPITALS + r"_ ]*\]")
_NUMBER_SLOT = re.compile(r"\{\d{1,3}\}")
_SPECIAL = re.compile(r"[„«“\"`{}<>\[\]$@#%_]|-> |raise |print")
_SPECIAL_TOKENS = re.compile(r"<\|\w+\|>|</?s>|<unk>|<br/?>|[​‌‍⁠﻿­\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_BREAK = " ␤ "
_ENDS = (".", "!", "?", "…")

#: Phrases of weak labels in the languages of the archive (cs, en, de, fr), by kind; matched on masked
#: segments in small letters, without commas, colons and semicolons.
PHRASES = {
    "filler": r"lorem ipsum|\b(bla|blah|text|texte|probe|sazba|asdf|testing) \1\b|\bfiller (copy|text)\b|\bsample paragraph\b|\bonly to show the column\b|výplňový text|ukázkový odstavec|zkušební sazba|jen pro tvar odstavce"
    r"|\bblindtext\b|\bfülltext\b|\bmustertext\b|\bmusterabsatz\b|nur text für das auge|faux texte|texte factice|texte de remplissage|paragraphe d.exemple|mots pour remplir",
    "instruction": r"\bgoes here\b|\binsert (?:[\w⟨⟩.'’-]+ )+here\b|\byour \w+ here\b|\b(?:add|enter|type) (?:your|the|a) (?:\w+ )+here\b|\bclick (?:here )?to (?:add|edit)\b|\btext to follow\b|\bdummy (caption|text)\b|\btk tk\b|\bxxx \w+ xxx\b"
    r"|sem vložte|sem přijde|sem napište|sem doplňte|zde napište|zde doplňte|zde bude text|klikněte pro (?:úpravu|přidání)|doplnit \w+ \w+|\bhier (?:\w+ )+(?:einfügen|eingeben)|text folgt"
    r"|platzhalter für|blindüberschrift|bitte ergänzen|zum bearbeiten klicken|texte à venir|insérer (?:[\w'’-]+ )+ici|votre \w+ ici|cliquez (?:ici )?pour (?:ajouter|modifier)|à compléter|nom de l.auteur \?",
    "error": r"(?:page|file|url|document) (?:was )?not found|internal server error|access denied|permission denied|bad (?:gateway|request)|gateway timeout|gateway time.out|request timeout|too many requests|service (?:is )?(?:temporarily )?unavailable|session has expired|no longer exists"
    r"|not available on this machine|try again later|return to the front page|you (?:do not|don.t) have permission|an (?:unexpected )?error (?:has )?occurred|something went wrong|connection (?:refused|timed out|was reset)|(?:down|closed) for maintenance"
    r"|establishing a database connection|upstream \w+ timed out|traceback \(most recent|^keyerror|fatal error|parse error|syntax error|undefined (?:variable|index|offset|function|method|property)|call to (?:a member|undefined)|uncaught \w+|exception in thread|unhandled exception|stack trace"
    r"|illegalstateexception|nullpointerexception|no such file or directory|segmentation fault|\bon line \d+$|^ora-\d|^at \w+\.\w+\.|^file ⟨q⟩ line"
    r"|stránka nebyla nalezena|soubor nebyl nalezen|chyba serveru|přístup odepřen|relace vypršela|dočasně mimo provoz|databáze neodpovídá|článek už neexistuje|zkuste to prosím později|zkontrolujte adresu"
    r"|časový limit|brána neodpověděla|chybná brána|neplatný požadavek|příliš mnoho požadavků|služba (?:je nedostupná|není dostupná)|došlo k (?:neočekávané )?chybě|nemáte oprávnění"
    r"|seite nicht gefunden|datei nicht gefunden|interner serverfehler|zugriff verweigert|sitzung ist abgelaufen|vorübergehend nicht erreichbar|leider nicht mehr verfügbar|versuchen sie es später|prüfen sie die adresse|zu viele anfragen"
    r"|zeitüberschreitung|fehlerhaftes gateway|ungültige anfrage|dienst nicht verfügbar|fehler ist aufgetreten|verbindung (?:abgelehnt|fehlgeschlagen)|keine berechtigung"
    r"|page introuvable|fichier introuvable|erreur interne du serveur|accès refusé|trop de requêtes|session a expiré|momentanément indisponible|article n.existe plus|veuillez réessayer|vérifiez l.adresse"
    r"|délai d.attente|délai dépassé|mauvaise passerelle|requête (?:incorrecte|invalide)|service indisponible|une erreur (?:est survenue|s.est produite)|vous n.avez pas l.autorisation",
    "scripts": r"(?:enable|activate|allow) javascript to|javascript (?:is|must be) (?:disabled|required|enabled|turned off|turned on)|requires javascript|does not run scripts|needs active scripting|turn on scripts to|zapněte javascript|povolte javascript|vyžaduje (?:povolené skripty|javascript)|nespouští skripty|^bez skriptů se"
    r"|aktivieren sie javascript|benötigt javascript|javascript ist deaktiviert|ohne aktivierte skripte|führt keine skripte|activer javascript pour|exécute pas les scripts|exige des scripts actifs|javascript est désactivé|sans javascript",
}
#: Words that are a label only in a segment of few words, in which nothing is said about them.
SHORT_PHRASES = (
    r"\b(?:error|chyba|fehler|erreur) (?:no |č |nr |n° )?\d{2,}\b|\bnot found\b|\bnenalezen[aoý]?\b|\bnicht gefunden\b|\bintrouvable\b|\bforbidden\b|\bunauthorized\b|\bzakázáno\b|\baccès interdit\b|\btimed out\b|\btime-?out\b|\btemps (?:d.attente )?écoulé\b"
    r"|\bunavailable\b|\bnedostupn[áéý]\b|\bnicht (?:verfügbar|erreichbar)\b|\bindisponible\b|\b(?:under|for|in) maintenance\b|\bmaintenance mode\b|\bprobíhá údržba\b|\bwartungs(?:arbeiten|modus)\b|\ben maintenance\b|\bserver error\b|\bneočekávaná chyba\b|\bunerwarteter fehler\b|\berreur inattendue\b"
    r"|\b(?:failed|unable) to (?:load|connect|open|read)\b|\bnepodařilo se (?:načíst|otevřít|připojit)\b|\bkonnte nicht (?:geladen|geöffnet|gefunden)\b|\bimpossible (?:de charger|d.ouvrir)\b|\bplease (?:log|sign) in\b|\bpřihlaste se\b|\bmelden sie sich an\b|\bveuillez vous connecter\b"
    r"|\b(?:unhandled |uncaught )?\w*exception\b|\bcore dumped\b|\bout of memory\b|\bobject object\b|\bscripts? (?:is|are) (?:disabled|blocked|required)\b|\bskripty (?:jsou )?(?:vypnuty|zakázány)\b|\bskripte (?:sind )?(?:deaktiviert|blockiert)\b|\bscripts (?:sont )?(?:désactivés|bloqués)\b"
    r"|\bplaceholder\b|\bplatzhalter(?:text)?\b|\bdummytext\b|\bzástupný text\b|\btexte bidon\b|\bquick brown fox\b|\bžluťoučký kůň\b|\bfranz jagt\b|\bvieux whisky\b|\bqwert[yz]\b|\bfoo bar\b|\blipsum\b"
    r"|\b(?:title|headline|heading|caption|picture|photo|text|name|author|teaser|lead) (?:goes )?here\b|\b(?:replace|delete) this (?:text|line|sentence|paragraph)\b|\bto be (?:written|supplied|filled in|confirmed)\b|\btb[acd]\b"
    r"|\b(?:titulek|nadpis|text|popisek|perex|jméno|foto) sem\b|\bbude doplněn[ao]?\b|\b(?:vložit|doplnit|dodat) (?:text|titulek|nadpis|popisek|perex|foto|jméno)\b"
    r"|\b(?:titel|überschrift|text|bildtext|bildunterschrift|name|autor|vorspann) (?:hier|folgt|einfügen|einsetzen|ergänzen)\b|\bhier (?:titel|überschrift|text|bildtext|name|autor)\b|\bwird (?:noch )?(?:ergänzt|nachgereicht)\b"
    r"|\b(?:titre|légende|texte|chapo|nom|photo|signature) (?:ici|à venir|à insérer|à compléter)\b|\bà (?:insérer|rédiger|remplacer)\b")
_SHORT_WORDS = 8
_AGAIN = "(?:bla|blah|text|texte|probe|sazba|asdf|testing)"
#: What labels, segments and features are made by: a model made by other rules is another model.
_RULES = zlib.crc32(repr((PHRASES, SHORT_PHRASES, _SLOT.pattern, _CODE.pattern, _QUOTED.pattern, NEGATIVES, BITS, THRESHOLD, FILLER_SHARE, WORDINGS, OF_WORDING)).encode())


def needed(parsed) -> set[str] | None:
    """Strings of which every match of a parsed pattern holds one, as long as can be told; None if none is needed."""
    best: set[str] | None = None
    run = ""

    def consider(found: set[str] | None) -> None:
        nonlocal best
        if found and (best is None or min(map(len, found)) > min(map(len, best))):
            best = found

    for op, value in [*parsed, (None, None)]:
        if op is re._constants.LITERAL:
            run += chr(value)
            continue
        consider({run} if run else None)
        run = ""
        if op is re._constants.SUBPATTERN:
            consider(needed(value[-1]))
        elif op is re._constants.BRANCH:
            parts = [needed(x) for x in value[1]]
            consider(set().union(*parts) if all(parts) else None)
        elif op in (re._constants.MAX_REPEAT, re._constants.MIN_REPEAT) and value[0] > 0:
            consider(needed(value[2]))
    return best


def alternatives(pattern: str) -> list[str]:
    """What a pattern's bars at its outermost level part."""
    out, depth, begin, i = [], 0, 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif c == "[":
            i = pattern.index("]", i + 2)
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            out.append(pattern[begin:i])
            begin = i + 1
        i += 1
    return [*out, pattern[begin:]]


@functools.lru_cache(maxsize=1)
def _triggers():
    """An automaton of strings one of which stands in every labelled phrase, each with (pattern, for short segments only) of its phrases."""
    import ahocorasick

    of: dict[str, list] = {}
    for patterns, short in ((PHRASES.values(), False), ([SHORT_PHRASES], True)):
        for one in (x for p in patterns for x in alternatives(p.replace(r"\1", _AGAIN))):
            for string in needed(re._parser.parse(one)) or {""}:
                of.setdefault(string, []).append((re.compile(one), short))
    found = ahocorasick.Automaton()
    for string, phrases in of.items():
        found.add_word(string, phrases)
    found.make_automaton()
    return found


_STATUS = re.compile(r"^http \d{3}\b|^(?:4\d\d|5\d\d) \w+(?: \w+){0,9}$|\(?\b(?:40\d|41\d|429|50\d)\)$")
#: Words before a set of one number, in the four languages: no slot.
_SET_WORD = re.compile(r"(?:množin\w*|menge|set|ensemble|mengen|sets|ensembles) ⟨n⟩")


def tokens(text: str) -> list[str]:
    """Words of a text between single spaces, with masks and slots as words and ␤ for a line break."""
    if _SPECIAL.search(text):
        text = _SPECIAL_TOKENS.sub(" ", text)
        text = _CODE.sub(" ⟨code⟩ ", text)
        text = _QUOTED.sub(" ⟨q⟩ ", text)
        text = _SLOT.sub(" ⟨slot⟩ ", text)
        text = _NUMBER_SLOT.sub(" ⟨n⟩ ", text)
    return text.replace("\n", _BREAK).split()


def word(token: str) -> tuple[str, bool]:
    """(the word as a feature, whether a segment ends with the token)."""
    if token[0] == "⟨" or token == "␤":
        return token, token == "␤"
    bare = token.lower().strip(".,;:!?…()[]–—-•*\"'")
    if bare.isdigit():
        kept = bare if re.fullmatch(r"40\d|41\d|429|50\d", bare) else "0"
    else:
        kept = re.sub(r"\d+", "0", bare)
    return kept or token, token.endswith(_ENDS) and len(bare) > 2


class _WordIds(dict):
    """Token -> hash of its word times 2, plus 1 if a segment ends with it."""

    def __missing__(self, token: str) -> int:
        w, end = word(token)
        value = (zlib.crc32(w.encode("utf-8", "surrogatepass")) << 1) | end
        if len(self) < 300_000 and len(token) <= 40:
            self[token] = value
        return value


_IDS = _WordIds()
_LINE_BREAK = zlib.crc32("␤".encode())


@dataclass
class Segments:
    """Segments of some documents: of which document, the first feature of each, and all features."""

    doc: np.ndarray
    first: np.ndarray
    features: np.ndarray
    of: np.ndarray  # the segment of each feature
    spans: np.ndarray  # [begin, end) in the documents' tokens
    line: np.ndarray
    words: np.ndarray
    of_word: np.ndarray  # the segment of each word


def _hashed(*parts: np.ndarray) -> np.ndarray:
    h = parts[0].astype(np.uint64)
    for p in parts[1:]:
        h = h * np.uint64(0x9E3779B97F4A7C15) + p.astype(np.uint64) + np.uint64(0x632BE59B)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


_SLOTS = np.array([zlib.crc32(x.encode()) for x in ("⟨slot⟩", "⟨n⟩")])


def _around_slots(words: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Begins of segments, so that a slot and the word on either side are a segment of their own."""
    at = np.nonzero(np.isin(words, _SLOTS))[0]
    begin = np.where(new[at], at, at - 1)
    after = at + 1
    inside = after < len(words)
    end = np.where(inside & ~new[np.minimum(after, len(words) - 1)], at + 2, after)
    out = new.copy()
    out[begin] = True
    out[end[end < len(words)]] = True
    return out


def segment(texts: list[list[str]], titles: list[str | None]) -> Segments:
    """Features of the segments of tokenised documents."""
    sizes = np.array([len(t) for t in texts])
    ids = np.array([_IDS[t] for ts in texts for t in ts], dtype=np.int64)
    if not len(ids):
        e = np.zeros(0, np.int64)
        return Segments(e, e, e, e, np.zeros((0, 2), np.int64), e, e, e)
    doc = np.repeat(np.arange(len(texts)), sizes)
    words, ends = ids >> 1, (ids & 1).astype(bool)
    new = np.ones(len(ids), bool)
    new[1:] = ends[:-1] | (doc[1:] != doc[:-1])
    new = _around_slots(words, new)
    seg = np.cumsum(new) - 1
    keep = words != _LINE_BREAK
    place = np.nonzero(keep)[0]
    words, doc, seg = words[keep], doc[keep], seg[keep]
    if not len(words):
        e = np.zeros(0, np.int64)
        return Segments(e, e, e, e, np.zeros((0, 2), np.int64), e, e, e)
    head = np.ones(len(seg), bool)
    head[1:] = seg[1:] != seg[:-1]
    begin = np.nonzero(head)[0]
    end = np.append(begin[1:], len(seg))
    seg = np.cumsum(head) - 1
    n = len(begin)
    owner = doc[begin]
    with np.errstate(over="ignore"):
        pair = np.nonzero(seg[1:] == seg[:-1])[0]
        triple = np.nonzero(seg[2:] == seg[:-2])[0] if len(seg) > 2 else np.zeros(0, np.int64)
        length = np.minimum(np.log2(end - begin + 1).astype(np.int64), 8)
        first_of_doc = np.ones(n, bool)
        first_of_doc[1:] = owner[1:] != owner[:-1]
        last_of_doc = np.append(first_of_doc[1:], True)
        title_words = [[_IDS[t] >> 1 for t in tokens(x)] if x else [] for x in titles]
        is_title = np.array([f and title_words[d] == words[b:e].tolist() for f, d, b, e in zip(first_of_doc, owner, begin, end)])
        doc_length = np.minimum(np.log2(sizes[owner] + 1).astype(np.int64), 12)
        seg_ids = np.arange(n)
        features = [
            (_hashed(words), seg), (_hashed(words[pair], words[pair + 1]), seg[pair]), (_hashed(words[triple], words[triple + 1], words[triple + 2]), seg[triple]),
            (_hashed(np.full(n, 1), words[begin]), seg_ids), (_hashed(words[end - 1], np.full(n, 2)), seg_ids),
            (_hashed(np.full(n, 3), length), seg_ids), (_hashed(np.full(n, 4), doc_length), seg_ids),
            (_hashed(np.full(n, 5), first_of_doc * 4 + last_of_doc * 2 + is_title), seg_ids),
        ]
    f, of = np.concatenate([x for x, _ in features]), np.concatenate([s for _, s in features])
    return Segments(owner, begin, f, of, np.stack([place[begin], place[end - 1] + 1], 1), np.cumsum(~keep)[place[begin]], words, seg)


def weak_label(words: str) -> bool:
    """Whether a masked segment, its words between spaces, looks like residue."""
    if "⟨" in words and ("⟨slot⟩" in words or "⟨n⟩" in words and not _SET_WORD.search(words)):
        return True
    short = None
    for _, phrases in _triggers().iter(words):
        for pattern, of_short in phrases:
            if of_short and short is None:
                short = words.count(" ") < _SHORT_WORDS and "⟨" not in words
            if (short or not of_short) and pattern.search(words):
                return True
    return ("4" in words or "5" in words) and bool(_STATUS.search(words))


def spread_filler(labels: np.ndarray, said: list[str], s: Segments) -> np.ndarray:
    """Filler goes on to the end of its line: the label of its first words holds for what follows them.

    Gives the segments that this holds for.
    """
    filler = np.zeros(len(said), bool)
    on = False
    for i, x in enumerate(said):
        if i and (s.doc[i] != s.doc[i - 1] or s.line[i] != s.line[i - 1]):
            on = False
        on = on or x.startswith("lorem ipsum")
        filler[i] = on
    labels |= filler
    return filler


def _words_of(ts: list[str], span: np.ndarray) -> str:
    return " ".join(t if t[0] == "⟨" else t.lower().strip(",;:…") for t in ts[span[0] : span[1]] if t != "␤").strip(". ")


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    threshold: float = THRESHOLD

    def scores(self, s: Segments) -> np.ndarray:
        return np.bincount(s.of, self.weights[s.features], minlength=len(s.doc)) + self.bias


def fit(s_features: np.ndarray, s_of: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, l2: float = 2e-6, rounds: int = 120, rate: float = 0.6) -> Model:
    """Logistic regression, both classes of equal weight, with an L2 penalty; full gradients, per-weight rates."""
    w = np.zeros(1 << BITS)
    b, gb = 0.0, 1e-8
    seen = np.full(1 << BITS, 1e-10)
    n = len(labels)
    weights = np.ones(n) if weights is None else weights
    each = np.where(labels, 0.5 / max(1.0, weights[labels].sum()), 0.5 / max(1.0, weights[~labels].sum())) * weights
    for _ in range(rounds):
        z = np.bincount(s_of, w[s_features], minlength=n) + b
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * each
        g = np.bincount(s_features, error[s_of], minlength=len(w)) + l2 * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
        gb += error.sum() ** 2
        b -= rate * error.sum() / np.sqrt(gb)
    return Model(w.astype(np.float32), float(b))


_SAMPLED = "source STRING, label BOOLEAN, filler BOOLEAN, features ARRAY<INT>, words ARRAY<INT>, wording BIGINT"


def _sampled(docs: DataFrame, n: int, id_col: str, text_col: str, sample_docs: int) -> DataFrame:
    """_SAMPLED and a weight: labelled segments of all documents, a few of each wording, and one in NEGATIVES of the others of a sample."""
    rate = min(1.0, sample_docs / max(n, 1))
    drawn = F.pmod(F.xxhash64(F.lit(8), F.col(id_col)), F.lit(1_000_000)) < int(rate * 1_000_000) + 1
    data = docs.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col("source"), F.lit("")).alias("source"), F.col(text_col).alias("t"), F.col("title").alias("title"), F.coalesce(drawn, F.lit(False)).alias("drawn"))

    def lists(values: np.ndarray, of: np.ndarray, n_segments: int, picked: np.ndarray) -> pa.Array:
        order = np.argsort(of, kind="stable")
        begins = np.searchsorted(of[order], np.arange(n_segments + 1))
        parts = [values[order[begins[i] : begins[i + 1]]].astype(np.int32) for i in picked]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                texts = [tokens(t) for t in part.column(1).to_pylist()]
                s = segment(texts, part.column(2).to_pylist())
                if not len(s.doc):
                    continue
                said = [_words_of(texts[d], span - base) for d, span, base in zip(s.doc, s.spans, _bases(texts)[s.doc])]
                labels = np.array([weak_label(x) for x in said])
                filler = spread_filler(labels, said, s)
                marks = np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in said])
                in_sample = np.asarray(part.column(3))[s.doc]
                picked = np.nonzero(labels | in_sample & ((marks % NEGATIVES == 0) | (np.array([x.count(" ") for x in said]) < 3)))[0]
                if not len(picked):
                    continue
                wording = np.array([zlib.adler32(said[i].encode("utf-8", "surrogatepass")) for i in picked]) << 32 | marks[picked]
                words = lists(s.words.astype(np.uint32).view(np.int32), s.of_word, len(s.doc), picked)
                columns = [part.column(0).take(pa.array(s.doc[picked])), pa.array(labels[picked]), pa.array(filler[picked]), lists(s.features, s.of, len(s.doc), picked), words, pa.array(wording.astype(np.uint64).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SAMPLED.split(", ")])

    rows = written(data.mapInArrow(run, _SAMPLED), "segments")
    counts = rows.where("label").groupBy("wording").agg(F.count(F.lit(1)).alias("n"))
    share = min(1.0, WORDINGS / max(1, counts.count()))
    some = rows.where("label").where(F.pmod(F.xxhash64("wording"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    no = F.row_number().over(Window.partitionBy("wording").orderBy(F.xxhash64("features"), "source", "filler"))
    few = some.withColumn("no", no).where(F.col("no") <= OF_WORDING).drop("no").join(counts, "wording")
    weight = F.col("n") / F.least("n", F.lit(OF_WORDING))
    return few.withColumn("weight", weight).drop("n").unionByName(rows.where("NOT label").withColumn("weight", F.lit(1.0))).drop("wording")


def filler_words(words: np.ndarray, of: np.ndarray, filler: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Words that belong to filler: in two of its segments at least, and in not many more of unlabelled ones.

    Filler that doesn't begin with its well-known words consists of the same words, so these tell it.
    """
    def seen_in(segments: np.ndarray) -> dict[int, int]:
        pairs = np.unique(np.stack([words[segments[of]], of[segments[of]]]), axis=1)
        values, n = np.unique(pairs[0], return_counts=True)
        return dict(zip(values.tolist(), n.tolist()))

    other = seen_in(~labels)
    return np.array([w for w, n in seen_in(filler).items() if n >= 2 and n >= FILLER_SHARE * (n + NEGATIVES * other.get(w, 0))], dtype=words.dtype)


def like_filler(words: np.ndarray, of: np.ndarray, n: int, known: np.ndarray) -> np.ndarray:
    """Segments of three words or more, three quarters of which are known words of filler."""
    total = np.bincount(of, minlength=n)
    return (total >= 3) & (np.bincount(of, np.isin(words, known), minlength=n) >= 0.75 * total)


def _bases(texts: list[list[str]]) -> np.ndarray:
    sizes = np.array([len(t) for t in texts])
    return np.cumsum(sizes) - sizes


def held_out(source: str) -> bool:
    return zlib.crc32(source.encode()) % 5 == 0


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values of all lists, number of the list of each)."""
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))


def train(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> tuple[Model | None, dict[str, float]]:
    """A model and its figures on the segments of unseen hosts; no model if no segment has a label."""
    t = _sampled(docs, n, id_col, text_col, sample_docs).toArrow()
    if not len(t) or not any(t["label"].to_pylist()):
        return None, {}
    flat, of = _flat(t["features"])
    words, of_word = _flat(t["words"])
    labels, filler = (t[c].to_numpy().astype(bool) for c in ("label", "filler"))
    labels |= like_filler(words, of_word, len(labels), filler_words(words, of_word, filler, labels))
    out = np.array([held_out(s) for s in t["source"].to_pylist()])
    if not labels[~out].any():
        out[:] = False
    number = np.cumsum(~out) - 1
    inner = ~out[of]
    weights = t["weight"].to_numpy()
    tried = fit(flat[inner], number[of[inner]], labels[~out], weights[~out])
    hit = np.bincount(of, tried.weights[flat], minlength=len(labels)) + tried.bias > tried.threshold
    seen = out if out.any() else np.ones(len(out), bool)
    def weighed(rows: np.ndarray) -> float:
        return float(weights[rows & seen].sum())

    both = weighed(hit & labels)
    model = fit(flat, of, labels, weights) if out.any() else tried
    return model, {"segments": weighed(seen), "labelled": weighed(labels), "precision": both / max(1.0, weighed(hit)), "recall": both / max(1.0, weighed(labels))}


def model_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> tuple[Model | None, dict[str, float]]:
    """The model of these documents: trained once, and kept in the shared folder under a fingerprint of them.

    Queries of one session over the same documents share it.
    """
    spark = docs.sparkSession
    row = F.xxhash64(F.col(id_col), F.col(text_col), F.col("title"), F.col("source"))
    n, mark = docs.agg(F.count(F.lit(1)), F.bit_xor(row)).first()
    kept = Generations(spark, f"{shared_dir(spark)}/residue-{n}-{(mark or 0) & (2**64 - 1):x}-{sample_docs}-{_RULES:x}")
    if not kept.last():
        model, figures = train(docs, n, id_col, text_col, sample_docs)
        if model is None:
            return None, {}
        at = np.nonzero(model.weights)[0]
        columns = [pa.array(at.astype(np.int32)), pa.array(model.weights[at])]
        weights = spark.createDataFrame(pa.Table.from_arrays(columns, names=["feature", "weight"]))
        kept.write(1, weights=weights, figures=spark.createDataFrame([*figures.items(), ("bias", model.bias)], "metric STRING, value DOUBLE"))
        kept.close(1)
    figures = {r.metric: r.value for r in kept.read("figures", [1], "metric STRING, value DOUBLE").collect()}
    t = kept.read("weights", [1], "feature INT, weight FLOAT").toArrow()  # at most 2^BITS rows
    weights = np.zeros(1 << BITS, np.float32)
    weights[t["feature"].to_numpy()] = t["weight"].to_numpy()
    return Model(weights, figures.pop("bias")), figures


def classify(docs: DataFrame, flagged: bool, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, keep: tuple[str, ...] = ()) -> DataFrame:
    """The documents that are cases (flagged) or are not: id and the columns of keep.

    Null, empty and blank texts are no cases. Copies of a case are cases, as the score depends on
    text and title only. Very long texts are scored whole. If nothing in the sample has a weak label
    there are no cases; no rows give no rows.
    """
    model, _ = model_of(docs, id_col, text_col, sample_docs)
    columns = [F.col(id_col), *[F.col(c) for c in keep if c != id_col]]
    data = docs.select(F.struct(*columns).alias("row"), F.col(text_col).alias("t"), F.col("title").alias("title"))
    schema = T.StructType([T.StructField("row", data.schema["row"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                case = np.zeros(part.num_rows, bool)
                if model is not None:
                    s = segment([tokens(t) if t else [] for t in part.column(1).to_pylist()], part.column(2).to_pylist())
                    case[s.doc[model.scores(s) > model.threshold]] = True
                yield part.select([0]).filter(pa.array(case if flagged else ~case))

    return data.mapInArrow(run, schema).select("row.*")


def validation(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(metric, value) on the segments of hosts that training didn't see."""
    _, figures = model_of(docs, id_col, text_col)
    return docs.sparkSession.createDataFrame(sorted(figures.items()), "metric STRING, value DOUBLE")
