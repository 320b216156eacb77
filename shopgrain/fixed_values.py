"""Values that decide results: word lists, names and message formats."""

# ---- fixed values: category slug -> label ----
CATEGORY_LABELS = {
    "add_a_comment": "adicionar_comentario",
    "art": "arte",
    "childrens": "crianca",
    "contemporary": "contemporaneo",
    "fiction": "ficcao",
    "business": "negocios",
    "default": "padrao",
    "fantasy": "fantasia",
    "food_and_drink": "comida_e_bebida",
    "health": "saude",
    "historical_fiction": "ficcao_historica",
    "history": "historia",
    "music": "musica",
    "mystery": "misterio",
    "new_adult": "adolescente",
    "nonfiction": "sem_ficcao",
    "philosophy": "filosofia",
    "poetry": "poesia",
    "politics": "politica",
    "science": "ciencia",
    "science_fiction": "ficcao_cientifica",
    "self_help": "auto_ajuda",
    "sequential_art": "arte_sequencial",
    "spirituality": "espiritualidade",
    "thriller": "acao",
    "travel": "viagem",
    "young_adult": "jovem",
}

# ---- fixed values: rating word -> number ----
RATING_NUMBERS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}

# ---- fixed values: stock below this is low ----
LOW_STOCK_BELOW = 5

# ---- fixed values: sheet names and name limits ----
ALL_SHEET = "Todos"
DASHBOARD_SHEET = "Painel"
MESSAGE_SHEET = "Informacoes"
FALLBACK_SHEET = "Categoria"
SHEET_NAME_CHARS = 31
FALLBACK_TABLE = "tabela"
TABLE_NAME_CHARS = 63

# ---- fixed values: message texts ----
EMPTY_RUN_MESSAGE = "Nenhum dado extraído. Verifique seletores."
CAPTURE_LINE = (
    "[%03d/%03d] titulo=%s | preco=%s | avaliacao=%s (%s) | disponibilidade=%s | "
    "estoque=%s | estoque_baixo=%s | categoria=%s"
)
PROGRESS_LINE = "Pagina %d | produtos_encontrados=%d | total_capturados=%d"
RATE_LINE = "Taxa GBP->BRL carregada: %s"
NO_RATE_LINE = "Taxa GBP->BRL indisponível. Mantendo valor original sem conversão."
ITEM_LIMIT_LINE = "Limite atingido: %d livros. Encerrando captura."
PAGE_LIMIT_LINE = "Limite de páginas atingido: %d. Encerrando captura."
NO_NEXT_PAGE_LINE = "Sem próxima página. Encerrando captura."
PRICE_SYMBOL = "R$"
MISSING = "N/A"
YES, NO = "SIM", "NAO"
