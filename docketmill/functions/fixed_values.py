"""Values that results depend on."""

# Word lists, patterns, weights and labels of the court-document domain.
# Patterns are in Python syntax with their flags (i, m, s); see regex.py for how Spark gets them.

#: Piece types in the order that breaks ties: name, least score, signals (pattern, flags, weight).
PIECE_RULES = [
    ("AUTUAÇÃO", 6, [
        (r"\bauto de autua[çc][aã]o\b", "i", 10),
        (r"\bautuo o\(a\) presente\b", "i", 10),
    ]),
    ("PORTARIA", 8, [
        (r"^[\s#]*PORTARIA\b", "im", 10),
        (r"\bportaria n[°º]\s*\d", "i", 10),
        (r"\binstaurar? inqu[ée]rito policial\b", "i", 8),
        (r"\bresolve:\s*$", "im", 3),
    ]),
    ("DENÚNCIA", 8, [
        (r"\boferec[eo]\s+a\s+presente\s+den[úu]ncia\b", "i", 10),
        (r"\bden(?:uncia|úncia)\s+como\s+incurso\b", "i", 10),
        (r"\bminist[ée]rio p[úu]blico.{0,80}oferec[eo]\b", "i", 6),
        (r"^[\s#]*DEN[ÚU]NCIA\b", "im", 10),
        (r"\bA\s+PRESENTE\s+DEN[ÚU]NCIA\b", "i", 8),
        (r"\bA(?:O)?S?\s+(?:Ex|MM\.?)?\s*Ju[íi]z[a-zo\s]*da\s+Vara\b[\s\S]{0,500}\bden[úu]ncia\b", "i", 8),
    ]),
    ("SENTENÇA", 8, [
        (r"^[\s#]*SENTEN[ÇC]A\b", "im", 10),
        (r"\bjulgo (?:totalmente )?procedente\b", "i", 8),
        (r"\bjulgo (?:totalmente )?improcedente\b", "i", 8),
        (r"\bcondeno o r[ée]u\b", "i", 8),
        (r"\babsolvo o r[ée]u\b", "i", 8),
        (r"\bjulgo extinto\b.{0,80}(?:m[ée]rito|execu)", "i", 6),
    ]),
    ("PRONÚNCIA", 8, [
        (r"\bpronuncio o r[ée]u\b", "i", 10),
        (r"\bimpronuncio o r[ée]u\b", "i", 10),
    ]),
    ("ALEGAÇÕES", 6, [
        (r"\balega[çc][õo]es finais\b", "i", 10),
        (r"\bmemoriais finais\b", "i", 8),
    ]),
    ("RESPOSTA", 6, [
        (r"\bresposta [àa] acusa[çc][aã]o\b", "i", 10),
        (r"\bdefesa pr[ée]via\b", "i", 8),
    ]),
    ("RECURSO", 8, [
        (r"^[\s#]*(?:RAZÕES DE )?APELA[ÇC][ÃA]O\s*$", "im", 10),
        (r"^[\s#]*(?:CONTRA)?RAZÕES RECURSAIS\b", "im", 10),
        (r"\binterp[õo]e o presente recurso\b", "i", 10),
        (r"\binterp[õo]e a presente apela[çc][aã]o\b", "i", 10),
        (r"\btempestividade do presente recurso\b", "i", 6),
        (r"\bapela[çc][aã]o\b", "i", 1),
    ]),
    ("AUDIENCIA_CUSTODIA", 8, [
        (r"\baudi[êe]ncia de cust[óo]dia\b", "i", 10),
        (r"\bart\.?\s*310[\s,]+(?:caput|do cpp|cpp)", "i", 8),
        (r"\bhomologa[çc][aã]o do flagrante\b", "i", 8),
        (r"\bauto de pris[aã]o em flagrante\b", "i", 6),
    ]),
    ("LIBERDADE_PROVISORIA", 8, [
        (r"\bconcedo (?:a )?liberdade provis[óo]ria\b", "i", 10),
        (r"\bdefiro (?:a )?liberdade provis[óo]ria\b", "i", 10),
        (r"\bart\.?\s*321\s*(?:do\s*)?cpp", "i", 8),
    ]),
    ("CAUTELAR_319", 8, [
        (r"\bart\.?\s*319[\s,]+(?:i|do cpp)", "i", 10),
        (r"\bmedidas? cautelares? diversas?\b", "i", 8),
        (r"\bcomparecimento (?:mensal|bimestral|quinzenal|peri[óo]dico)", "i", 10),
        (r"\bcomparecer (?:mensal|bimestral|quinzenal)mente\b", "i", 10),
    ]),
    ("REVOGACAO_CAUTELAR", 8, [
        (r"\brevogo as (?:medidas )?cautelares\b", "i", 10),
        (r"\bextintas as cautelares\b", "i", 10),
        (r"\bextingo as (?:medidas )?cautelares\b", "i", 10),
    ]),
    ("PREVENTIVA", 8, [
        (r"\bdecreto (?:a )?pris[aã]o preventiva\b", "i", 10),
        (r"\bconverto em pris[aã]o preventiva\b", "i", 10),
    ]),
    ("TERMO_COMPROMISSO", 8, [
        (r"\btermo de compromisso\b", "i", 10),
        (r"\bcompromisso de comparecimento\b", "i", 10),
        (r"\bci[êe]ncia das (?:medidas )?cautelares\b", "i", 8),
    ]),
    ("SURSIS_PROCESSUAL", 8, [
        (r"\bsuspens[aã]o condicional do processo\b", "i", 10),
        (r"\bart\.?\s*89\s*(?:da\s*)?lei\s*9[.\s]?099", "i", 10),
        (r"\bsursis processual\b", "i", 8),
        (r"\bper[íi]odo de prova\b", "i", 6),
    ]),
    ("ANPP", 8, [
        (r"\bacordo de n[aã]o persecu[çc][aã]o penal\b", "i", 10),
        (r"\bart\.?\s*28[-\s]?a\s*(?:do\s*)?cpp", "i", 10),
        (r"\banpp\b", "i", 6),
    ]),
    ("TRANSACAO_PENAL", 8, [
        (r"\btransa[çc][aã]o penal\b", "i", 10),
        (r"\bart\.?\s*76\s*(?:da\s*)?lei\s*9[.\s]?099", "i", 10),
    ]),
    ("EXTINCAO_PUNIBILIDADE", 8, [
        (r"\bdeclaro extinta a punibilidade\b", "i", 10),
        (r"\bextin[gç]o a punibilidade\b", "i", 10),
        (r"\bextinta a punibilidade\b", "i", 8),
        (r"\bart\.?\s*107\s*(?:do\s*)?cp\b", "i", 6),
    ]),
    ("CUMPRIMENTO_SURSIS", 15, [
        (r"\bcumprido o per[íi]odo de prova\b", "i", 20),
        (r"\bart\.?\s*89[\s,]+§\s*5", "i", 20),
    ]),
    ("CUMPRIMENTO_ANPP", 15, [
        (r"\bcumpridas as condi[çc][õo]es\b.{0,200}\banpp\b", "i", 20),
        (r"\bart\.?\s*28[-\s]?a[\s,]+§\s*13", "i", 20),
    ]),
    ("TRANSITO_JULGADO", 8, [
        (r"\btr[âa]nsito em julgado\b", "i", 10),
        (r"\btransitou em julgado\b", "i", 10),
        (r"\btransitada em julgado\b", "i", 10),
        (r"\bexpedir guia de execu[çc][aã]o\b", "i", 8),
    ]),
    ("BO", 8, [
        (r"\bboletim de ocorr[êe]ncia\b", "i", 10),
        (r"\brelato\/hist[óo]rico\b", "i", 6),
        (r"\bdados do registro\b", "i", 3),
    ]),
    ("DECLARAÇÃO", 8, [
        (r"\btermo de declara[çc][õo]es\b", "i", 10),
        (r"\b[àa]s perguntas do\(a\) delegado\b", "i", 8),
    ]),
    ("INTERROGATÓRIO", 8, [
        (r"\btermo de (?:qualifica[çc][aã]o e )?interrogat[óo]rio\b", "i", 10),
    ]),
    ("RELATÓRIO", 8, [
        (r"\brelat[óo]rio final\b", "i", 10),
        (r"\bdos fatos e circunst[âa]ncias apuradas\b", "i", 8),
    ]),
    ("MPU", 8, [
        (r"\bmedida\(?s?\)? protetiva\(?s?\)? de urg[êe]ncia\b", "i", 10),
        (r"\bpedido de medida protetiva\b", "i", 10),
    ]),
    ("RISCO", 8, [
        (r"\bformul[áa]rio nacional de avalia[çc][aã]o de risco\b", "i", 10),
    ]),
    ("LAUDO", 8, [
        (r"\blaudo de exame\b", "i", 10),
        (r"\bexame m[ée]dico pericial\b", "i", 10),
    ]),
    ("DECISÃO", 8, [
        (r"^[\s#]*DECIS[ÃA]O\b", "im", 10),
        (r"\bdecido que\b", "i", 8),
        (r"\b(?:de|in)firo o pedido\b", "i", 8),
    ]),
    ("DESPACHO", 8, [
        (r"^[\s#]*DESPACHO\b", "im", 10),
        (r"\bvistos,?\s*etc\.?\b", "i", 6),
        (r"\bcite-se\b", "i", 4),
        (r"\bintime-se\b", "i", 3),
        (r"\bcumpra-se\b", "i", 3),
    ]),
    ("ATA", 8, [
        (r"\bata de audi[êe]ncia\b", "i", 10),
        (r"\baberta a audi[êe]ncia\b", "i", 8),
    ]),
    ("OFÍCIO", 6, [
        (r"^[\s#]*OF[ÍI]CIO\s+n[°º]", "im", 10),
        (r"\bof[íi]cio n[°º]\s*[\d.\-/]+", "i", 8),
    ]),
    ("CARTA PRECATÓRIA", 8, [
        (r"\bcarta precat[óo]ria\b", "i", 10),
    ]),
    ("CERTIDÃO", 6, [
        (r"^[\s#]*CERTID[ÃA]O(?:\s+DE\s+\w+)?\s*$", "im", 10),
        (r"\bcertifico,?\s+para os devidos fins\b", "i", 8),
        (r"\bcertifico que\b", "i", 6),
    ]),
    ("INTIMAÇÃO", 6, [
        (r"^[\s#]*INTIMA[ÇC][ÃA]O\b", "im", 8),
        (r"\bfica(?:m)? (?:a parte |as partes )?intimad[oa]s?\b", "i", 6),
    ]),
    ("MANDADO", 8, [
        (r"^[\s#]*MANDADO\s+DE\b", "im", 10),
        (r"\bmandado de (?:cita|intima|penhora|bus|pris|condu)", "i", 8),
    ]),
    ("ALVARÁ", 8, [
        (r"\balvar[áa] de soltura\b", "i", 10),
    ]),
    ("CONCLUSOS", 8, [
        (r"\btorno os autos conclusos\b", "i", 10),
        (r"\bautos conclusos\b", "i", 8),
    ]),
    ("REMESSA", 8, [
        (r"\bfa[çc]o a remessa\b", "i", 10),
        (r"\btermo de remessa\b", "i", 10),
    ]),
    ("PETIÇÃO", 6, [
        (r"^[\s#]*PETI[ÇC][ÃA]O INICIAL\b", "im", 10),
        (r"\bao?s? ju[íi]zo\s+da?\s+vara\b", "i", 6),
        (r"\bexcelent[íi]ssim[oa]\s+senhor[a]?\s+(?:doutor|dr\.?|ju[íi]z)", "i", 6),
        (r"\bnestes\s+termos,?\s*pede\s+deferimento\b", "i", 6),
        (r"\bpeti[çc][ãa]o ministerial\b", "i", 8),
    ]),
    ("ASSINATURA", 10, [
        (r"\bgerado por sinesp\b", "i", 10),
    ]),
]

#: Types rendered in full.
FULL_PIECES = [
    "AUTUAÇÃO",
    "PORTARIA",
    "DENÚNCIA",
    "SENTENÇA",
    "PRONÚNCIA",
    "ALEGAÇÕES",
    "RESPOSTA",
    "RECURSO",
    "AUDIENCIA_CUSTODIA",
    "LIBERDADE_PROVISORIA",
    "CAUTELAR_319",
    "REVOGACAO_CAUTELAR",
    "PREVENTIVA",
    "TERMO_COMPROMISSO",
    "SURSIS_PROCESSUAL",
    "ANPP",
    "TRANSACAO_PENAL",
    "EXTINCAO_PUNIBILIDADE",
    "CUMPRIMENTO_SURSIS",
    "CUMPRIMENTO_ANPP",
    "TRANSITO_JULGADO",
    "BO",
    "DECLARAÇÃO",
    "INTERROGATÓRIO",
    "RELATÓRIO",
    "MPU",
    "RISCO",
    "LAUDO",
    "DECISÃO",
    "DESPACHO",
    "ATA",
    "CARTA PRECATÓRIA",
    "PETIÇÃO",
]

#: Types listed in short.
SUMMARY_PIECES = [
    "OFÍCIO",
    "CERTIDÃO",
    "INTIMAÇÃO",
    "MANDADO",
    "ALVARÁ",
    "CONCLUSOS",
    "REMESSA",
]

#: Types dropped.
DROPPED_PIECES = [
    "ASSINATURA",
]

#: Types that impose measures.
MEASURE_SOURCES = [
    "AUDIENCIA_CUSTODIA",
    "LIBERDADE_PROVISORIA",
    "CAUTELAR_319",
    "ATA",
    "DECISÃO",
    "TERMO_COMPROMISSO",
    "SURSIS_PROCESSUAL",
    "ANPP",
    "TRANSACAO_PENAL",
]

#: Deletions in order: name, pattern, flags.
CLEANING_RULES = [
    ("usuario_gerou", r"Este documento foi gerado pelo usu[aá]rio[^\n]{0,200}(?=\n|$)", "i"),
    ("num_doc_meta", r"N[úu]mero do documento:\s*\d+[^\n]{0,150}(?=\n|$)", "i"),
    ("assinado_elet", r"Assinado eletronicamente[^\n]{0,200}(?=\n|$)", "i"),
    ("doc_assinado_brasilia", r"Documento assinado eletronicamente[^\n]{0,300}?Bras[íi]lia\.?", "is"),
    ("gerado_assinado_pje", r"\(documento gerado e assinado automaticamente pelo PJe\)", "i"),
    ("mac", r"C[óo]digo Verificador \(MAC\)[^\n]{0,200}(?=\n|$)", "i"),
    ("autenticidade", r"A autenticidade do documento[^\n]{0,500}?(?=\n\n|\Z)", "is"),
    ("informe_verificador", r"Informe o c[óo]digo verificador[^\n]{0,200}(?=\n|$)", "i"),
    ("ainda_podera", r"Este documento ainda poder[áa][^\n]{0,200}(?=\n|$)", "i"),
    ("url", r"https?://\S+", "i"),
    ("ip_registro", r"IP de Registro:[^\n]{0,80}(?=\n|$)", "i"),
    ("num_pag_rodape", r"(?:Num[.\s]+|Documento\s+n[º°.]?\s*|Id[.\s]+|ID[:\s]+)\d{5,}\s*[-–]\s*P[áa]g[.\s]+\d+", "i"),
    ("pg_total", r"Pg\.\s*\d+/\d+", "i"),
    ("pag_de", r"P[áa]gina\s+\d+\s+de\s+\d+", "i"),
    ("fls_visto", r"Fls:?\s*\d*\s*\n?\s*Visto:?", "i"),
    ("impresso_por", r"Impresso por:[^\n]{0,150}(?=\n|$)", "i"),
    ("data_impressao", r"Data de Impress[ãa]o:[^\n]{0,80}(?=\n|$)", "i"),
    ("ppe", r"PPe\s*[-–]\s*Procedimentos Policiais[^\n]{0,200}(?=\n|$)", "i"),
    ("sinesp", "Gerado por Sinesp Seguran[çc]a", "i"),
    ("sigilo_admin", r"O sigilo deste documento[^\n]{0,500}?administrativas\.?", "is"),
    ("min_justica", r"Minist[ée]rio da\s*\n?\s*Justi[çc]a e Seguran[çc]a P[úu]blica", "i"),
    ("senasp", r"Secretaria Nacional de\s*\n?\s*Seguran[çc]a P[úu]blica", "i"),
    ("tjba_pje", r"TJBA\s*\n?\s*PJe\s*[-–]\s*Processo Judicial[^\n]{0,150}", "i"),
    ("delegacia_ba", r"GOVERNO DO ESTADO DA BAHIA\s*\n?\s*POL[ÍI]CIA CIVIL\s*\n?\s*DELEGACIA TERRITORIAL\s*[-–][^\n]{0,200}[-–]\s*BA\s*\n?", "i"),
    ("delegacia_se", r"GOVERNO DO ESTADO DE SERGIPE\s*\n?\s*POL[ÍI]CIA CIVIL[^\n]{0,150}\n", "i"),
    ("delegacia_ba_curto", r"GOVERNO DO ESTADO DA BAHIA\s*\n?\s*DELEGACIA TERRITORIAL[^\n]{0,200}\n", "i"),
    ("seguranca_ba", r"ESTADO DA BAHIA\s*\n?\s*SECRETARIA DA SEGURAN[CÇ]A P[ÚU]BLICA[^\n]{0,200}\n", "i"),
    ("poder_judiciario", r"PODER JUDICI[ÁA]RIO[\s\n]+TRIBUNAL DE JUSTI[ÇC]A DO ESTADO DA BAHIA[\s\n]*", "i"),
    ("autos_n", r"Autos n[°º]\s*[\d.\-/]+\s*\n?", "i"),
    ("imagem_md", r"!\[[^\]]{0,200}\]\([^)]{0,300}\)", "i"),
    ("codigo_barras", r"^\d{10,}\s*$", "im"),
]

DOC_ID_WITH_PAGE = r"(?:Num[.\s]+|Documento\s+n[º°.]?\s*|Id[.\s]+|ID[:\s]+)(\d{5,})\s*[-–]\s*P[áa]g[.\s]+(\d+)"
DOC_ID_ALONE = r"(?:Num[.\s]+|Documento\s+n[º°.]?\s*|Id[.\s]+|ID[:\s]+)(\d{5,})"

#: Cover signals: pattern, flags, weight.
COVER_SIGNALS = [
    (r"PJe\s*[-–]\s*Processo Judicial", "i", 3),
    (r"[ÓO]rg[ãa]o\s+julgador:", "i", 2),
    (r"\bClasse:\s*\w", "i", 2),
    (r"\bAssuntos?:\s*\w", "i", 1),
    (r"\bValor\s+da\s+causa:", "i", 2),
    (r"(?:Última|Ultima)\s+distribui[çc][ãa]o", "i", 2),
    (r"\bPartes?\b.{0,100}\b(?:Procurador|Advogado)\b", "is", 1),
    (r"\bDocumentos?\b[\s\S]{0,200}\bTipo\b", "i", 2),
    (r"\bN[úu]mero do processo:", "i", 1),
]

CORRUPT_CHARS = "[∞ÈÁ„‡ïÙ˙ıÌı‰ÒÏü¿¬«¶®©ª¯±²³µ¸¹º»¼½¾]"
VALID_CHARS = "[a-zA-ZáéíóúâêôãõàèìòùäëïöüçñÁÉÍÓÚÂÊÔÃÕÀÈÌÒÙÄËÏÖÜÇÑ0-9 ]"

CPF = (r"\b(\d{3}\.?\d{3}\.?\d{3}-?\d{2})\b", "")
RG = (r"\b(?:RG|R\.G\.|identidade)[:.\s]+([\d.\-]+(?:\s*[/-]?\s*[A-Z]{2,5})?)", "i")
PHONE = (r"\(?\b(\d{2})\)?\s*((?:9\s*\d{4})|(?:\d{4,5}))\s*[-.\s]?\s*(\d{4})\b", "")
CEP = (r"\b(\d{5}-?\d{3})\b", "")
DATE = (r"\b(\d{1,2})[/\-](\d{1,2})[/\-](\d{4})\b", "")
DECISION_VERBS = (r"\b(?:Decido|Defiro|Indefiro|Concedo|Revogo|Homologo|Decreto|Declaro|Absolvo|Condeno)\b", "i")
PREAMBLE = (r"^(?:VISTOS|RELATORIO|RELATÓRIO|EMENTA|ACÓRDÃO|ACORDAO)\b", "im")

#: Tracked piece types and their flags.
EVENT_FLAGS = [
    ("AUDIENCIA_CUSTODIA", "tem_audiencia_custodia"),
    ("LIBERDADE_PROVISORIA", "tem_liberdade_provisoria"),
    ("CAUTELAR_319", "tem_cautelar_319"),
    ("TERMO_COMPROMISSO", "tem_termo_compromisso"),
    ("SURSIS_PROCESSUAL", "tem_sursis_processual"),
    ("ANPP", "tem_anpp"),
    ("TRANSACAO_PENAL", "tem_transacao_penal"),
    ("REVOGACAO_CAUTELAR", "tem_revogacao"),
    ("PREVENTIVA", "tem_preventiva_decretada"),
    ("SENTENÇA", "tem_sentenca"),
    ("TRANSITO_JULGADO", "tem_transito_julgado"),
    ("EXTINCAO_PUNIBILIDADE", "tem_extincao_punibilidade"),
    ("CUMPRIMENTO_SURSIS", "tem_cumprimento_sursis"),
    ("CUMPRIMENTO_ANPP", "tem_cumprimento_anpp"),
]

#: Precautionary measures: name, pattern, flags.
MEASURES = [
    ("comparecimento_mensal", r"comparecimento\s+(?:mensal|todo\s+m[êe]s|a\s+cada\s+m[êe]s)", "i"),
    ("comparecimento_quinzenal", r"comparecimento\s+quinzenal|a\s+cada\s+15\s+dias", "i"),
    ("comparecimento_periodico", r"comparecimento\s+peri[óo]dico|comparecer\s+em\s+ju[íi]zo", "i"),
    ("proibicao_acesso_local", r"proibi[çc][ãa]o\s+de\s+acesso|proibido\s+de\s+frequentar|n[ãa]o\s+frequentar", "i"),
    ("proibicao_contato_vitima", r"proibi[çc][ãa]o\s+(?:de\s+)?(?:o\s+)?contato|proibido\s+(?:o\s+)?contato|n[ãa]o\s+manter\s+contato|afastamento\s+da\s+v[íi]tima", "i"),
    ("proibicao_ausentar_comarca", r"proibi[çc][ãa]o\s+de\s+(?:se\s+)?ausentar(?:\s+da)?\s+comarca|n[ãa]o\s+(?:se\s+)?ausentar\s+da\s+comarca", "i"),
    ("recolhimento_noturno", r"recolhimento\s+(?:noturno|domiciliar\s+noturno)", "i"),
    ("monitoracao_eletronica", r"monitora(?:c|çã)o\s+eletr[ôo]nica|tornozeleira", "i"),
    ("suspensao_funcao_publica", r"suspens[ãa]o\s+do\s+exerc[íi]cio\s+(?:de\s+)?fun[çc][ãa]o\s+p[úu]blica", "i"),
    ("fianca", r"\bfian[çc]a\b", "i"),
    ("internacao_provisoria", r"interna[çc][ãa]o\s+provis[óo]ria", "i"),
]

#: Qualification fields: name, pattern.
QUALIFICATION = [
    ("nome", r"(?:Nome|N[oO]ME)[:.\s]+([A-ZÁ-Ú][A-Za-zÁ-Úá-ú\s.'\-]{4,80}?)(?=\s*\n|\s*$)"),
    ("alcunha", r"(?:Alcunha|Vulgo|Apelido)[:.\s]+([^\n]{2,40})"),
    ("cpf", r"\b(\d{3}\.?\d{3}\.?\d{3}-?\d{2})\b"),
    ("rg", r"(?:RG|R\.G\.|Identidade)[:.\s]+([\d.\-]+(?:\s*[/-]?\s*[A-Z]{2,5})?)"),
    ("data_nascimento", r"(?:Data\s+de\s+nascimento|Nasc(?:ido|imento)?(?:\s+em)?)[:.\s]+(\d{1,2}[/\-.]\d{1,2}[/\-.]\d{2,4})"),
    ("filiacao_mae", r"(?:M[ãa]e|Filiac[ãa]o materna)[:.\s]+([A-ZÁ-Ú][A-Za-zÁ-Úá-ú\s.'\-]{4,80}?)(?=\s*\n|\s*$)"),
    ("filiacao_pai", r"(?:Pai|Filiac[ãa]o paterna)[:.\s]+([A-ZÁ-Ú][A-Za-zÁ-Úá-ú\s.'\-]{4,80}?)(?=\s*\n|\s*$)"),
    ("endereco", r"(?:Endere[çc]o|Residente\s+(?:na?|em))[:.\s]+([A-Za-zÁ-Úá-ú0-9,\s.'\-º°ºª/]{10,160})"),
    ("telefone", r"\(?\b(\d{2})\)?\s*((?:9\s*\d{4})|(?:\d{4,5}))\s*[-.\s]?\s*(\d{4})\b"),
    ("profissao", r"(?:Profiss[ãa]o|Ocupa[çc][ãa]o)[:.\s]+([A-Za-zÁ-Úá-ú\s.'\-]{3,40})"),
    ("estado_civil", r"(?:Estado\s+civil)[:.\s]+(solteir[oa]|casad[oa]|divorciad[oa]|viuv[oa]|vi[uú]v[oa]|uni[ãa]o\s+est[áa]vel|amasiad[oa])"),
    ("naturalidade", r"(?:Natural\s+de|Naturalidade)[:.\s]+([A-Za-zÁ-Úá-ú\s.\-/]{3,60})"),
    ("escolaridade", r"(?:Escolaridade|Instru[çc][ãa]o)[:.\s]+([A-Za-zÁ-Úá-ú\s.\-]{3,60})"),
]

#: Canonical piece labels.
PIECE_LABELS = [
    "DENUNCIA",
    "BOLETIM_OCORRENCIA",
    "AUTO_PRISAO_FLAGRANTE",
    "AUDIENCIA_CUSTODIA",
    "LIBERDADE_PROVISORIA",
    "PREVENTIVA",
    "REVOGACAO_CAUTELAR",
    "CAUTELAR_319",
    "TERMO_COMPROMISSO",
    "SURSIS_PROCESSUAL",
    "ANPP",
    "TRANSACAO_PENAL",
    "CUMPRIMENTO_SURSIS",
    "CUMPRIMENTO_ANPP",
    "SENTENCA",
    "TRANSITO_JULGADO",
    "EXTINCAO_PUNIBILIDADE",
    "MANIFESTACAO_MP",
    "MANIFESTACAO_DEFESA",
    "DESPACHO",
    "DECISAO",
    "ALEGACOES_FINAIS",
    "DOC",
]

#: Other names of piece labels.
PIECE_ALIASES = [
    ("denuncia", "DENUNCIA"),
    ("denúncia", "DENUNCIA"),
    ("petição inicial", "DENUNCIA"),
    ("bo", "BOLETIM_OCORRENCIA"),
    ("boletim", "BOLETIM_OCORRENCIA"),
    ("boletim de ocorrência", "BOLETIM_OCORRENCIA"),
    ("ocorrencia", "BOLETIM_OCORRENCIA"),
    ("apf", "AUTO_PRISAO_FLAGRANTE"),
    ("auto de prisão em flagrante", "AUTO_PRISAO_FLAGRANTE"),
    ("flagrante", "AUTO_PRISAO_FLAGRANTE"),
    ("audiencia de custodia", "AUDIENCIA_CUSTODIA"),
    ("audiência de custódia", "AUDIENCIA_CUSTODIA"),
    ("custodia", "AUDIENCIA_CUSTODIA"),
    ("liberdade provisoria", "LIBERDADE_PROVISORIA"),
    ("liberdade provisória", "LIBERDADE_PROVISORIA"),
    ("lp", "LIBERDADE_PROVISORIA"),
    ("prisao preventiva", "PREVENTIVA"),
    ("prisão preventiva", "PREVENTIVA"),
    ("preventiva", "PREVENTIVA"),
    ("revogacao", "REVOGACAO_CAUTELAR"),
    ("revogação", "REVOGACAO_CAUTELAR"),
    ("revogacao de cautelar", "REVOGACAO_CAUTELAR"),
    ("cautelar 319", "CAUTELAR_319"),
    ("cautelares", "CAUTELAR_319"),
    ("medidas cautelares", "CAUTELAR_319"),
    ("termo de compromisso", "TERMO_COMPROMISSO"),
    ("termo de cautelares", "TERMO_COMPROMISSO"),
    ("sursis", "SURSIS_PROCESSUAL"),
    ("sursis processual", "SURSIS_PROCESSUAL"),
    ("suspensao condicional do processo", "SURSIS_PROCESSUAL"),
    ("suspensão condicional do processo", "SURSIS_PROCESSUAL"),
    ("anpp", "ANPP"),
    ("acordo de nao persecucao penal", "ANPP"),
    ("acordo de não persecução penal", "ANPP"),
    ("transacao penal", "TRANSACAO_PENAL"),
    ("transação penal", "TRANSACAO_PENAL"),
    ("cumprimento sursis", "CUMPRIMENTO_SURSIS"),
    ("cumprimento anpp", "CUMPRIMENTO_ANPP"),
    ("sentenca", "SENTENCA"),
    ("sentença", "SENTENCA"),
    ("decisao final", "SENTENCA"),
    ("transito em julgado", "TRANSITO_JULGADO"),
    ("trânsito em julgado", "TRANSITO_JULGADO"),
    ("transito", "TRANSITO_JULGADO"),
    ("extincao da punibilidade", "EXTINCAO_PUNIBILIDADE"),
    ("extinção da punibilidade", "EXTINCAO_PUNIBILIDADE"),
    ("mp", "MANIFESTACAO_MP"),
    ("manifestacao mp", "MANIFESTACAO_MP"),
    ("manifestacao do mp", "MANIFESTACAO_MP"),
    ("promotor", "MANIFESTACAO_MP"),
    ("promocao", "MANIFESTACAO_MP"),
    ("manifestacao defesa", "MANIFESTACAO_DEFESA"),
    ("defesa", "MANIFESTACAO_DEFESA"),
    ("resposta a acusacao", "MANIFESTACAO_DEFESA"),
    ("despacho", "DESPACHO"),
    ("decisao", "DECISAO"),
    ("decisão", "DECISAO"),
    ("alegacoes finais", "ALEGACOES_FINAIS"),
    ("alegações finais", "ALEGACOES_FINAIS"),
    ("memoriais", "ALEGACOES_FINAIS"),
    ("doc", "DOC"),
    ("documento", "DOC"),
    ("anexo", "DOC"),
]

#: Who acts, by the first keyword found.
EXECUTORS = [
    ("Cartório", ["expedir citação", "citar", "intimar", "certificar", "juntar", "remeter ao tj", "remessa", "expedir mandado", "expedir alvará", "expedir ofício", "publicar", "abrir vista ao mp", "reintimar mp", "intimar delegado", "contrarrazões", "processar apelação", "processar recurso"]),
    ("Assessoria", ["minutar sentença", "minutar decisão", "analisar recebimento", "analisar absolvição sumária", "pronunciar", "impronunciar", "reconhecer prescrição", "minutar", "elaborar", "homologar anpp", "homologar transação", "homologar arquivamento", "revisar prisão preventiva", "analisar progressão"]),
    ("Juiz", ["assinar", "despachar", "decidir", "sentenciar"]),
    ("Externo", ["aguardar mp", "aguardar delegado", "aguardar laudo", "aguardar arf", "aguardar carta precatória", "aguardar contrarrazões", "aguardar resposta"]),
]

#: How easy an act is, by the first keyword found.
EASE = [
    ("expedir citação", 5),
    ("citar", 5),
    ("intimar", 5),
    ("certificar", 5),
    ("juntar", 5),
    ("publicar", 5),
    ("abrir vista", 5),
    ("reintimar", 5),
    ("expedir mandado", 5),
    ("expedir alvará", 5),
    ("expedir ofício", 5),
    ("reconhecer prescrição", 4),
    ("homologar arquivamento", 4),
    ("homologar transação", 4),
    ("homologar anpp", 4),
    ("remeter ao tj", 4),
    ("processar apelação", 4),
    ("processar recurso", 4),
    ("nomear defensor", 4),
    ("suspender processo", 4),
    ("designar audiência", 4),
    ("redesignar", 4),
    ("receber denúncia", 3),
    ("analisar recebimento", 3),
    ("deferir medida protetiva", 3),
    ("revisar prisão", 3),
    ("revogar sursis", 3),
    ("intimar delegado", 3),
    ("pronunciar", 2),
    ("impronunciar", 2),
    ("absolvição sumária", 2),
    ("analisar absolvição", 2),
    ("decretar preventiva", 2),
    ("liberdade provisória", 2),
    ("minutar sentença", 1),
    ("sentenciar", 1),
    ("minutar decisão", 1),
]

#: Case classes and their names.
CASE_CLASSES = [
    ("TCO", ["Termo Circunstanciado", "TCO"]),
    ("IP", ["Inquérito Policial", "IP"]),
    ("APOrd", ["Ação Penal - Procedimento Ordinário", "APOrd"]),
    ("APSum", ["Ação Penal - Procedimento Sumário", "APSum"]),
    ("APSumss", ["Ação Penal - Procedimento Sumaríssimo", "APSumss"]),
    ("Juri", ["Tribunal do Júri", "Juri", "Júri", "Ação Penal - Procedimento do Tribunal do Júri"]),
]

#: Prompt of a class, by the first pattern found.
CLASS_ROUTES = [
    (r"termo\s+circunstanciado|t\.?c\.?o\.?", "i", "TCO"),
    (r"in[qu]u[ée]rito\s+policial|\bIPL?\b", "i", "IP"),
    (r"tribunal\s+do\s+j[uú]ri|j[uú]ri", "i", "Juri"),
    (r"sumar[ií]ssim[ao]|jecrim|juizado\s+especial\s+criminal", "i", "APSumss"),
    ("sum[áa]ri[ao]", "i", "APSum"),
    (r"ordin[áa]ri[ao]|a[çc][ãa]o\s+penal", "i", "APOrd"),
]

#: Group id prefixes of normalised sheet names.
SHEET_PREFIXES = [
    ("litispendencia", "lit"),
    ("coisa julgada", "cj"),
    ("filtro estrito", "estrito"),
    ("filtro medio", "medio"),
    ("filtro amplo", "amplo"),
]

#: Former sheet names.
SHEET_ALIASES = [
    ("⭐ Litispendência", "Litispendência"),
    ("⚠ Coisa Julgada", "Coisa Julgada"),
]
