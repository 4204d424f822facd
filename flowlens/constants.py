"""Domain constants.

FIXED VALUES: everything in this module must equal the analysed system's
values for results to match (labels, rule keywords, thresholds, bands).
They are listed plainly, in the order the rules apply.
"""
from __future__ import annotations

# --- FIXED VALUES: life-cycle stages (model output labels) -------------------
STAGES = ["Início", "Crescimento", "Maturidade", "Declínio", "Reestruturação"]
HEALTHY_STAGES = ["Crescimento", "Maturidade"]

# --- FIXED VALUES: activity text -> sector, first matching rule wins --------
SECTOR_RULES = [
    ("MINERACAO", ["MINERIO", "MINERA", "EXTRAÇÃO", "EXTRACAO"]),
    ("ENERGIA", ["ENERGIA", "ELETRICA", "GERAÇÃO", "GERACAO"]),
    ("PETROLEO", ["PETROLEO", "GAS", "COMBUSTIVEL"]),
    ("SIDERURGIA", ["SIDERUR", "METALUR", "AÇO", "ACO", "FERRO"]),
    ("CONSTRUCAO", ["CONSTRUÇÃO", "CONSTRUCAO", "OBRAS"]),
    ("MANUFATURA", ["MANUFATURA", "FABRICA", "INDUSTRI"]),
    ("QUIMICA", ["QUIMIC"]),
    ("FARMACEUTICA", ["FARMACEUTICA", "MEDICAMENTO", "FARMACIA"]),
    ("TECNOLOGIA", ["TECNOLOGIA", "SOFTWARE", "TI", "DIGITAL"]),
    ("VAREJO", ["VAREJO", "COMERCIO", "LOJA", "VENDA"]),
    ("SERVICOS", ["SERVICO", "CONSULTORIA", "ASSESSORIA"]),
    ("ALIMENTACAO", ["ALIMENTO", "ALIMENTAR", "RESTAURANTE", "COMIDA"]),
]
DEFAULT_SECTOR = "OUTROS"

# --- FIXED VALUES: sector profile (cycle years, capital intensive) ----------
SECTOR_PROFILES = {
    "MINERACAO": (10, True),
    "ENERGIA": (15, True),
    "PETROLEO": (20, True),
    "SIDERURGIA": (12, True),
    "CONSTRUCAO": (7, True),
    "MANUFATURA": (8, True),
    "QUIMICA": (9, False),
    "FARMACEUTICA": (6, False),
    "TECNOLOGIA": (3, False),
    "VAREJO": (4, False),
    "SERVICOS": (3, False),
    "ALIMENTACAO": (5, False),
    "OUTROS": (6, False),
}
SECTORS = list(SECTOR_PROFILES)

# --- FIXED VALUES: size bands on yearly revenue, half-open [lo, hi) ----------
SIZE_BANDS = [
    ("MICRO", 0.0, 360_000.0),
    ("PEQUENA", 360_000.0, 4_800_000.0),
    ("MEDIA", 4_800_000.0, 300_000_000.0),
    ("GRANDE", 300_000_000.0, float("inf")),
]
SIZE_ORDINAL = {"MICRO": 0, "PEQUENA": 1, "MEDIA": 2, "GRANDE": 3}

# --- FIXED VALUES: payment channels ----------------------------------------
CHANNEL_MAP = {"PIX": "PIX", "TED": "TED", "BOLETO": "BOLETO", "SISTEMICO": "OUTROS"}
CHANNEL_DEFAULT = "OUTROS"
CHANNELS = ["PIX", "TED", "BOLETO", "OUTROS"]
ALL_CHANNELS = "TODOS"

# --- FIXED VALUES: data-quality defaults -------------------------------------
DATE_FLOOR = "2025-03-01"

# --- FIXED VALUES: peer benchmarking ------------------------------------------
PEER_METRICS = ["receita_media", "margem_media", "crescimento_medio", "consistencia_fluxo"]
QUARTILES = [(75, "Q1 (Top 25%)"), (50, "Q2 (25-50%)"), (25, "Q3 (50-75%)")]
QUARTILE_LAST = "Q4 (Bottom 25%)"
MARKET_POSITIONS = [(80, "Líder de Mercado"), (60, "Competidor Forte"),
                    (40, "Posição Mediana"), (20, "Desafiante")]
MARKET_POSITION_LAST = "Posição Frágil"
ALL_SIZES = "TODOS"

# --- FIXED VALUES: risk levels -------------------------------------------------
RISK_LEVELS = [(0.5, "CRÍTICO"), (0.3, "ALTO"), (0.15, "MÉDIO")]
RISK_LEVEL_LAST = "BAIXO"
OVERALL_RISK = [(70, "CRÍTICO"), (50, "ALTO"), (30, "MÉDIO")]
SEVERITY = [(0.5, "CATASTRÓFICO", "12+ meses"), (0.3, "SEVERO", "6-12 meses"),
            (0.15, "MODERADO", "3-6 meses")]
SEVERITY_LAST = ("LEVE", "1-3 meses")

# --- FIXED VALUES: metric display dictionary (name, label, unit) ------------
METRIC_LABELS = {
    "receita_mensal": "Receita Mensal",
    "despesa_mensal": "Despesa Mensal",
    "fluxo_liquido": "Fluxo de Caixa",
    "VL_FATU": "Faturamento Anual",
    "VL_SLDO": "Saldo Atual",
    "g_receita_mom": "Crescimento MoM",
    "crescimento_mom_medio": "Crescimento Médio MoM",
    "tendencia_receita": "Tendência de Receita",
    "tendencia_fluxo": "Tendência de Fluxo",
    "vol_receita_3m": "Volatilidade 3M",
    "volatilidade_receita": "Volatilidade da Receita",
    "volatilidade_fluxo": "Volatilidade do Fluxo",
    "coef_variacao_receita": "Coeficiente de Variação",
    "consistencia_fluxo_positivo": "Consistência de Fluxo+",
    "pct_meses_fluxo_pos": "% Meses Fluxo Positivo",
    "margem_media": "Margem Operacional",
    "tempo_operacao_anos": "Anos de Operação",
    "num_meses": "Meses Analisados",
    "taxa_recuperacao": "Taxa de Recuperação",
    "DS_CNAE": "Setor/CNAE",
    "DT_ABRT": "Data de Abertura",
    "estagio": "Estágio Empresarial",
    "confianca": "Confiança do Modelo",
}
METRIC_UNITS = {
    "receita_mensal": "R$",
    "despesa_mensal": "R$",
    "fluxo_liquido": "R$",
    "VL_FATU": "R$",
    "VL_SLDO": "R$",
    "g_receita_mom": "%",
    "crescimento_mom_medio": "%",
    "vol_receita_3m": "R$",
    "volatilidade_receita": "R$",
    "volatilidade_fluxo": "R$",
    "consistencia_fluxo_positivo": "%",
    "margem_media": "%",
    "taxa_recuperacao": "%",
    "confianca": "%",
    "tempo_operacao_anos": "anos",
    "num_meses": "meses",
}
HIGHER_IS_BETTER = ["receita_mensal", "g_receita_mom", "crescimento_mom_medio",
                    "consistencia_fluxo_positivo", "margem_media", "taxa_recuperacao",
                    "confianca", "fluxo_liquido"]
LOWER_IS_BETTER = ["vol_receita_3m", "volatilidade_receita", "volatilidade_fluxo",
                   "coef_variacao_receita"]
KPI_METRICS = ["estagio", "confianca", "fluxo_liquido_medio", "crescimento_mom_medio"]

# --- FIXED VALUES: the nine clustering features, in model order -------------
CLUSTER_FEATURES = [
    "receita_mensal_media",
    "crescimento_mom_medio",
    "volatilidade_receita",
    "fluxo_liquido_medio",
    "consistencia_fluxo_positivo",
    "margem_media",
    "tendencia_receita",
    "coef_variacao_receita",
    "taxa_recuperacao",
]

# --- FIXED VALUES: the 21 supervised features, in model order --------------
SUPERVISED_FEATURES = [
    "idade_anos", "VL_FATU", "VL_SLDO", "faturamento_normalizado",
    "ciclo_setor_anos", "capital_intensivo", "saude_saldo",
    "receita_trend", "fluxo_trend", "receita_cv", "fluxo_cv",
    "consistencia_receita", "consistencia_fluxo", "diversificacao_contrapartes",
    "canais_utilizados", "receita_media", "fluxo_medio", "num_meses_ativo",
    "maturidade_relativa", "performance_vs_porte", "eficiencia_capital",
]

# --- FIXED VALUES: ensemble financial inputs, in model order ---------------
ENSEMBLE_FINANCIAL = ["receita_media", "despesa_media", "fluxo_medio", "margem_media",
                      "receita_total", "crescimento_medio", "volatilidade_receita",
                      "consistencia_fluxo"]

# FIXED VALUES: per loss scenario, the code of its description (what the loss
# cuts) and the codes of its mitigation strategies, in order.
SCENARIO_TEXTS = {
    "top_payer_loss": ("loss_cuts_receipts", ["diversify_payers", "alternative_contracts", "strategic_safety_stock"]),
    "top_payee_loss": ("loss_cuts_payments", ["diversify_payees", "new_sales_channels", "retain_existing_clients"]),
    "top_partners_joint_loss": ("joint_loss_cuts_both", ["geographic_and_sector_spread", "long_term_contracts",
                                                         "emergency_reserves", "contingency_plan"]),
}
