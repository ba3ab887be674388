"""Dictionaries and thresholds of the relevance rules, as data.

All rules take a ``Vocabulary``, so the engine serves other languages and topics
as well; ``DEFAULT`` is the Brazilian market news vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass, field


def _set(text: str) -> frozenset[str]:
    return frozenset(x.strip() for x in text.replace("\n", ",").split(",") if x.strip())


# fixed values: word lists, section lists and thresholds

_CORE = _set("""
    b3, copom, ibovespa, selic, acao, acoes, agronegocio, balanco, banco central, bolsa, cambio, credito, criptomoeda, debenture, dividendo, dolar, economia,
    empresa, etf, fii, fundo, ifix, inflacao, investimento, investimentos, investidor, investidores, investir, ipo, juros, lucro, mercado, petrobras, real,
    renda fixa, risco, tesouro, vale
""")
_BRAZIL = _set("""
    b3, copom, ibovespa, selic, cvm, ipca, tesouro direto, banco central do brasil, banco central brasileiro, bcb, bovespa, dolar, dolar futuro, ifix,
    mercado brasileiro, real brasileiro, anbima, bndes, brasil, brasileira, brasileiras, brasileiro, brasileiros, ibc-br, ministerio da fazenda
""")
_FOCUS = _set("""
    banco central, banco central do brasil, bcb, boletim focus, focus, b3, copom, ibovespa, selic, aluguel, cambio, cdi, credito, curva de juros, debenture,
    debentures, dividendo, dividendos, dolar, emprestimo, financiamento, indice futuro, inflacao, ipca, juros, mini-indice, minicontratos, pib, pmi, pmis,
    provento, proventos, renda fixa, spread, swap cambial, tesouro, tesouro direto
""")
_FOREIGN = _set("""
    argentina, argentino, argentinos, asia-pacifico, bank of england, bce, boe, buenos aires, cepo, china, dow jones, ecb, eua, europa, fed, federal reserve,
    fomc, fmi, japao, japones, japonesa, milei, nasdaq, nikkei, powell, s&p 500, treasury, wall street, yuan, zona do euro
""")
_HOME = _set("""
    b3, copom, ibovespa, selic, cvm, ipca, tesouro direto, banco central do brasil, banco central brasileiro, bcb, bovespa, ifix, mercado brasileiro,
    real brasileiro, banco do brasil, bb seguridade, bndes, credito imobiliario, dis, economia brasileira, itau, itau unibanco, juros futuros,
    ministerio da fazenda, petrobras, pib brasileiro, tesouro nacional, vale, ante o real, contra o real, frente ao real, ibc-br
""")
_METRICS = _set("balanco, ebitda, guidance, lucro, prejuizo")
_PERIODS = _set("""
    1 tri, 1o tri, 1t, 2 tri, 2o tri, 2t, 3 tri, 3o tri, 3t, 4 tri, 4o tri, 4t, ano, anual, primeiro trimestre, quarto trimestre, segundo trimestre, semestre,
    semestral, terceiro trimestre, trimestre, trimestral
""")
_AGGREGATES = _set("bancos, companhias, empresas, industria, industrias, setor, setores")
_ANNOUNCEMENTS = _set("""
    anuncia dividendo, aprova dividendo, aprova jcp, data ex-dividendo, data ex dividendo, declara jcp, distribui dividendo, distribuicao de dividendo,
    dividend yield de, dividendo por acao, dividendos por acao, jcp de r$, pagamento de dividendo, pagamento de dividendos, retorno com dividendos de,
    apresenta resultado, divulga balanco, divulga resultado, lucro liquido de, registra lucro, registra prejuizo, reporta resultado, reverte prejuizo,
    reverte resultado, lucra no, lucra em, lucra r$, prejuizo no, prejuizo em, prejuizo r$, resultado liquido, resultado operacional, balanco trimestral,
    resultado trimestral, resultado do trimestre, lucro do trimestre, prejuizo do trimestre, receita do trimestre, receita trimestral, contas do trimestre,
    apos o balanco, apos balanco, anuncio de oferta de acoes, anuncio de oferta primaria de acoes, dados operacionais, numeros operacionais, oferta de acoes,
    oferta primaria de acoes, oferta subsequente de acoes, volume medio negociado, volume negociado em, coloca debenture, emissao de debenture,
    emite debenture, oferta de debenture
""")
_GENERIC_TITLES = _set("after market, after-market, comprar ou vender, como investir, eventos que o mercado deve olhar, no radar, vale a pena, veja mais")
_LIVE_TITLES = _set("ao vivo, cobertura ao vivo, destaques, minuto a minuto, ultimas noticias, ultimas notícias")
_ROUNDUP_PATHS = _set("ao-vivo, after-market, comprar-ou-vender, cobertura-ao-vivo, destaques, minuto-a-minuto, no-radar, ultimas-noticias")
_PATH_DENY = _set("esg, fundos, mercado-imobiliario, minhas-financas, onde-investir, stock-pickers")
_SECTION_DENY = _set("esg, onde-investir")
_ALLOW = {
    "InfoMoney": _set("mercados, economia, negocios, fundos, cotacoes, colunistas"),
    "Exame": _set("invest, economia, mercado, negocios"),
    "Valor Econômico": _set("financas, empresas, politica, brasil, mundo, agronegocios, legislacao"),
}
_DENY = {
    "InfoMoney": _set("consumo, esportes, entretenimento, tecnologia, turismo, variedades"),
    "Exame": _set("casual, carreira, esg, minhas-financas, pop, science-health"),
    "Valor Econômico": _set("eu-e, carreira, cultura, gastronomia"),
}
_STRICT = {"empresas": 4, "negocios": 4, "politica": 6}
_PRIORITY = {"Valor Econômico": 0, "InfoMoney": 1, "Exame": 2}
OUTPUT_FIELDS = ("source", "url", "published_at", "week_key", "week_start", "week_end", "tags", "title", "description", "sentiment_text")


@dataclass(frozen=True)
class Vocabulary:
    core: frozenset[str] = _CORE
    brazil: frozenset[str] = _BRAZIL  #: counts twice
    focus: frozenset[str] = _FOCUS
    foreign: frozenset[str] = _FOREIGN
    home: frozenset[str] = _HOME
    exchange_word: str = "dolar"  #: home context too, next to exchange_sign
    exchange_sign: str = "r$"
    metrics: frozenset[str] = _METRICS
    periods: frozenset[str] = _PERIODS
    aggregates: frozenset[str] = _AGGREGATES
    announcements: frozenset[str] = _ANNOUNCEMENTS
    generic_titles: frozenset[str] = _GENERIC_TITLES
    live_titles: frozenset[str] = _LIVE_TITLES
    roundup_paths: frozenset[str] = _ROUNDUP_PATHS
    path_deny: frozenset[str] = _PATH_DENY
    section_deny: frozenset[str] = _SECTION_DENY
    section_allow_by_source: dict[str, frozenset[str]] = field(default_factory=lambda: dict(_ALLOW))
    section_deny_by_source: dict[str, frozenset[str]] = field(default_factory=lambda: dict(_DENY))
    strict_sections: dict[str, int] = field(default_factory=lambda: dict(_STRICT))
    source_priority: dict[str, int] = field(default_factory=lambda: dict(_PRIORITY))
    least_score: int = 2
    least_score_strict_early: int = 3  #: in strict sections, before the page is read
    last_priority: int = 99  #: of sources not listed


DEFAULT = Vocabulary()
