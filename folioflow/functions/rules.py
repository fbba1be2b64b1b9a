"""The versioned rule set: what must match, as data. Python's `re` is the dialect of BOUNDARIES; the rest is written for both dialects."""

from __future__ import annotations

import re
from dataclasses import dataclass

VERSION = "0.9"


@dataclass(frozen=True)
class Rule:
    """A pattern of turn boundaries. Its place in BOUNDARIES is its priority. A text without any of needs, folded, has no match."""

    name: str
    pattern: str
    ignore_case: bool
    needs: tuple[str, ...]

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.M | (re.I if self.ignore_case else 0))


# Boundary patterns in order of priority.
BOUNDARIES = (
    Rule("bold_boundary", r"^§([^§\n]{3,400}):\s*$", False, ("§",)),
    Rule("floor_grant", r"^(La Presidencia (?:le )?(?:concede|otorga) el uso de la palabra\s*\n?(?:al|a la) (?:honorable )?(?:Representante|Senador[a]?|Congresista)\s+[^\n:]{1,80}(?:\n[^\n:]{1,60})?):", True, ("el uso de la palabra",)),
    Rule("con_venia", r"^[-\s]*(Con la venia de(?:l se[ñn]or Presidente|\s+la Presidencia)[^\n]*\n(?:palabra\s+)?(?:el doctor |la doctora |el se[ñn]or |la se[ñn]ora |[Ll]a honorable\s+|[Ee]l honorable\s+|[A-ZÁÉÍÓÚÑÜ])[^\n:]{2,80}(?:\n[^\n:]{2,60})?):", False, ("con la venia de",)),
    Rule("se_le_concede", r"^(Se le concede el uso de la palabra\s+(?:al|a la)\s+(?:honorable\s+)?(?:Representante|Senador[a]?|Congresista)\s+[^\n:]{3,80}(?:\n[^\n:]{3,60})?):", True, ("se le concede el uso de la palabra",)),
    Rule("dash_role_verb", r"^-\s+(?:[^\n,]{0,40},\s+)?(?:el|la)\s+se[ñn]or[a]?\s+(Presidente[a]?|Secretari[ao])(?:\s+de\s+la\s+Comisi[oó]n)?[,\s]+(?:expresa|indica|manifiesta|se[ñn]ala|afirma)\s*:", True, ("expresa", "indica", "manifiesta", "ala", "afirma")),
    Rule("dash_doctor_verb", r"^-\s+(?:el|la)\s+doctor[a]?\s+([A-ZÁÉÍÓÚÑÜ][^\n,]{3,60})[^:]+?(?:expresa|indica|manifiesta|se[ñn]ala|afirma)\s*:", True, ("doctor",)),
    Rule("tiene_uso", r"^((?:Tiene|tiene) (?:el uso de la palabra|la palabra)[^\n:]{0,80}):", False, ("tiene ",)),
    Rule("honorable_tiene_dot", r"honorable\s+(?:Representante|Senador[a]?|Congresista)\s+([A-ZÁÉÍÓÚÑÜ][^\n,]{2,50}),\s+tiene\s+la\s+palabra\.", True, ("honorable",)),
    Rule("tiene_palabra_dot", r"[Tt]iene\s+la\s+palabra\s+(?:el\s+|la\s+)?(?:honorable\s+)?(?:Representante|Senador[a]?|Congresista)\s+([A-ZÁÉÍÓÚÑÜ][^\n.]{2,60}(?:\n[^\n.]{2,60})?)\.", True, ("tiene",)),
    Rule("tiene_palabra", r"(?:tiene la palabra\s+(?:el|la)\s+honorable\s+(?:Representante|Senador[a]?|Congresista)\s+([A-ZÁÉÍÓÚÑÜ][^\n:]{3,70}(?:\n[^\n:]{3,50})?)):", True, ("tiene la palabra",)),
    Rule("quien_verbo", r"(?:interviene\s+)?(?:el|la)\s+honorable\s+(?:Senador[a]?|Representante|Congresista)\s+([A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+(?:\s+[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+){1,5})[,;.]\s+quien\s+(?:manifiesta|expresa|indica|afirma|se[ñn]ala|expone)\s*:", True, ("quien",)),
    Rule("honorable_verb", r"(?:el|la)\s+honorable\s+(?:Senador[a]?|Representante|Congresista)\s+([A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+(?:\s+[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+){1,5})[,\s]*(?:expresa|indica|manifiesta|se[ñn]ala|afirma|expone)\s*:", True, ("honorable",)),
    Rule("otorga_quien", r"(?:le\s+)?otorga(?:\s+el\s+uso\s+de\s+la\s+palabra)?\s+al?\s+(?:honorable\s+)?(?:Senador[a]?|Representante|Congresista)\s+([A-ZÁÉÍÓÚÑÜ][^\n:]{3,80}(?:\n[^\n:]{3,60})?)[,;]\s+quien\s+(?:manifiesta|expresa|indica|afirma|se[ñn]ala|expone)\s*:", True, ("otorga",)),
    Rule("otorga_doctor", r"otorga(?:\s+el\s+uso\s+de\s+la\s+palabra)?\s+al?\s+(?:se[ñn]or[a]?\s+)?doctor[a]?\s+([A-ZÁÉÍÓÚÑÜ][^\n,]{3,60})[^:]+?,?\s*quien\s+(?:manifiesta|expresa|indica|afirma|se[ñn]ala|expone)\s*:", True, ("otorga",)),
    Rule("intervencion", r"^(Intervenci[oó]n de(?:l|\s+la)? (?:Representante(?:\s+a la C[aá]mara)?|Senador[a]?)[,\s]*\n?[^\n:]{3,80}):", True, ("intervenci",)),
    Rule("direccion", r"^(Direcci[oó]n(?:\s+de)?\s+Presidencia,?\s*[^\n:]{3,60}(?:\n[^\n:]{2,50})?):", True, ("direcci",)),
    Rule("role_label", r"^(Presidente[a]?|Vicepresidente[a]?|Secretari[ao]|Subsecretari[ao]):\s*$", True, ("president", "secretari")),
    Rule("role_semicolon", r"^((?:Secretari[ao]|Subsecretari[ao]);?\s+[A-ZÁÉÍÓÚÑÜ][^\n:;]{3,60}):", False, ("secretari",)),
    Rule("role_with_name", r"^((?:Presidente[a]?|Vicepresidente[a]?|Secretari[ao]|Subsecretari[ao]|Director[a]?\s+(?:de |Nacional)?[^\n,]{0,30})\s+[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+(?:\s+[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+){1,4}):", False, ("president", "secretari", "director")),
    Rule("honorable", r"^(Honorable (?:Representante|Senador[a]?|Congresista)\s+[A-ZÁÉÍÓÚÑÜ][^\n:]{3,80}(?:\n[^\n:]{3,50})?):", True, ("honorable ",)),
    Rule("minister", r"^((?:Ministro[a]?|Viceministro[a]?)\s+de\s+[^\n,]{3,50},?\s*(?:doctor[a]?\s+)?[A-ZÁÉÍÓÚÑÜ][^\n:]{3,60}(?:\n[^\n:]{3,40})?):", True, ("ministro",)),
    Rule("senador_representante", r"^((?:Senador[a]?|Representante)\s+[A-ZÁÉÍÓÚÑÜ][^\n:]{3,70}(?:\n(?!-)[^\n:]{3,50})?):", False, ("senador", "representante")),
    Rule("named_speaker", r"^([A-ZÁÉÍÓÚÑÜ][a-záéíóúñüA-Z]+(?:\s+(?:de\s+la?\s+)?[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+){2,4}):", False, ()),
)

# Attributions that are no speakers.
NOT_SPEAKERS = r"^(DIRECTORES?|Autores?|Ponentes?|[Ll]os honorables?|[Ll]as honorables?|Excusas?|Incapacidades?|[Cc]ontestaron|[Ss]e registraron?|[Pp]or el|[Cc]uestionario|[Pp]roposici[oó]n|[Pp]royecto|[Dd]ej[oó]|[Cc]on excusa|Publicaci[oó]n|Resultado|Honorables Representantes?|En el transcurso de la sesi[oó]n se hicieron presentes|Dejan de asistir con excusa|Contestan los siguientes honorables|Con excusa los honorables|Minuto de silencio|Himno Nacional|VOTACI[OÓ]N\s|SEGUNDA VOTACI[OÓ]N|Presidente (?:del? )?Senado|Secretario General (?:del? )?(?:Senado|C[aá]mara)|Publicaciones?|Se hicieron presentes)(?:[:\s]|$)"
LETTER_REFERENCE = r"\bReferencia\b|[.,]\s*Ponente"
LEADING_RECESS = r"^\(RECESO\)\s*"
LONGEST_ATTRIBUTION = 450

# Markers inside a turn.
BOLD = "§"
DIVIDED = r"-\n(?=[a-z])"
PAGE_MARK = r"\[PAGE \d+\]"
GLYPH_LINE = r"(?m)^[^\n]*(?:\(cid:\d+\)){10,}[^\n]*$"
GLYPH_BOLD_LINE = r"(?m)^§[^\n]*(?:\(cid:\d+\)){3,}[^\n]*$"
GLYPH_ATTRIBUTION = "§[CID_ATTRIBUTION]:"
SESSION_CLOSE = r"(?:Se levanta|Se da por terminada?|Se termina|Con esto se da|Se da fin a)\s+la\s+sesi[oó]n"
DASH_LINE = r"(?m)^-\s+[A-Z][^\n]{0,200}$"
PROCEDURAL = r"^\s*\(?\s*(RECESO|Receso|Sesi[oó]n Informal|Sesi[oó]n Formal)\s*\)?\s*$"
CHAIR_CHANGE = r"(?:Preside la sesi[oó]n (?:el|la) honorable|Asume la Presidencia)[^\n]*([A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+(?:\s+[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+){1,4})"
CHAIR_MARK = r"Preside la sesi[oó]n (?:el|la) honorable|Asume la Presidencia"
CONTINUATION = r"Contin[uú]a (?:con|en|haciendo uso de) el uso de la palabra"
VOTE = r"[Vv]ota\s+(?:s[íi]|no)\b"
VOTES = 3

# Names and what stands before them, as changes of the chair and session headers have them.
NAME = r"[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+(?: +(?:(?:de|del) +(?:la +|los +)?)?[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+){1,4}"
TITLES = r"\A[\s,]*(?:(?:el|la)\s+)?(?:honorable\s+)?(?:(?:Representante|Senador[a]?|Congresista|doctor[a]?)\s+)*"

# How a transcript begins.
FLOOR_GRANTS = (
    r"La Presidencia concede el uso de la palabra",
    r"La Presidencia le concede el uso de la palabra",
    r"Con la venia de la Presidencia",
    r"La Presidencia otorga el uso de la palabra",
    r"Se le concede el uso de la palabra",
    r"tiene el uso de la palabra",
    r"Tiene el uso de la palabra",
    r"[Ee]l se[ñn]or[a]?\s+[Pp]residente[a]?\s+(?:le\s+)?concede el uso de la palabra",
    r"[Ll]a se[ñn]ora?\s+[Pp]residenta?\s+(?:le\s+)?concede el uso de la palabra",
)
ROLE_LINES = (
    r"^Presidente[a]?:\s*$",
    r"^Vicepresidente[a]?:\s*$",
    r"^Secretari[ao]:\s*$",
    r"^Subsecretari[ao]:\s*$",
    r"^§?Direcci[oó]n de Presidencia,",
    r"^Intervenci[oó]n del? (?:Representante|Senador)",
    r"^Honorable (?:Representante|Senador[a]?|Congresista) [A-Z]",
)
ADMINISTRATIVE = r"^§?Registro manual\b"

# Header fields.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
GAZETTE_NUMBER = r"[Nn][°ºo\.]\s*(\d[\d.,]*)"
ACT = r"ACTA\s+[Nn][°ºo]?[Ú]?MERO?\s+(\d+)"
LONG_DATE = r"(\d{1,2})\s+de\s+(enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre)\s+de\s+(\d{4})"
CHAMBER = r"(C[aá]mara de Representantes|Senado de la Rep[uú]blica|comisiones? conjuntas?)"
COMMITTEE = r"COMISI[OÓ]N\s+([A-ZÁÉÍÓÚÑÜ][^\n]{5,80}?)(?:\n|PERMANENTE|$)"
CONFIDENCE = ("low", "medium", "high")

# Quality checks.
ROLE_WORDS = ("Presidente", "Presidenta", "Vicepresidente", "Vicepresidenta", "Secretario", "Secretaria", "Subsecretario", "Subsecretaria", "Presidencia")
ROLE_PHRASES = ("El Presidente", "La Presidenta", "El Secretario", "La Secretaria")
TOO_LONG, TOO_SHORT, ROLE_LENGTH, ATTRIBUTION_LENGTH, RUN = 3000, 15, 3, 300, 3
RUNNING_HEADER = r"(?:enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre)\s+de\s+\d{4}\s+(?:Gaceta|GACETA)"
DASH_START = r"(?m)^-\s+[A-Z]"
TRAILING_VERB = r"[,;.]\s*(?:quien\s+)?(?:expresa|indica|manifiesta|afirma|se[ñn]ala|interviene|da apertura|hace uso de la palabra|tiene la palabra|inicia|contesta|responde|solicita|presenta|propone)\b"

# Page layout, for pages of CANONICAL points.
CANONICAL = (609.4, 963.8)
HEADER_TOP_FIRST, HEADER_TOP_REST = 210, 84
MASTHEAD_SIZE = 40
LEFT, RIGHT, FULL = (50, 300), (310, 609), (50, 609)
RIGHT_WORDS = 10
LINE_TOLERANCE = 3.0
FOOTER_BUCKET = 3
FOOTER = "IMPRENTA NACIONAL"
SCANNED_SHARE = 0.30
