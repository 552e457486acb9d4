"""Labels, thresholds and column lists that published results must carry verbatim."""

# Anomaly types.
EXTREME = "Consumo extremadamente alto"
HIGH = "Consumo alto"
SUDDEN = "Incremento brusco"
SUSPICIOUSLY_LOW = "Consumo sospechosamente bajo"
MODERATE = "Variacion moderada"
NORMAL = "Consumo normal"
UNCLASSIFIED = "Sin clasificar"
CRITICAL_TYPE = "Alerta consumo crítico > {limit:g} kWh"
CRITICAL_TYPE_PLAIN = "Alerta consumo critico > {limit:g} kWh"

# Risk levels.
RISK_HIGH = "Alto"
RISK_MEDIUM = "Medio"
RISK_LOW = "Bajo"
RISK_CRITICAL = "Crítico"
ALERT_LEVEL = "CRITICO"
UNKNOWN = "DESCONOCIDO"

# Customer segments.
CHAMPION = "Champion"
ACTIVE = "Cliente activo"
AT_RISK = "En riesgo"
LOST = "Perdido"

# Thresholds.
Z_EXTREME = 3.0
Z_HIGH = 2.0
Z_LOW = -2.0
PCT_SUDDEN = 100.0
CRITICAL_KWH = 500.0
HOURLY_KWH = 500.0
VALIDITY_MIN_PCT = 85.0
PRECISION_MIN_PCT = 90.0
LATENCY_MAX_SECONDS = 5.0
HEATMAP_HIGH_PCT = 0.05
HEATMAP_MEDIUM_PCT = 0.02
DEFAULT_DEPARTMENT = "LA LIBERTAD"

# Column lists.
STATISTICS_VALUES = [
    "consumo_promedio", "consumo_std", "importe_promedio", "importe_std",
    "consumo_minimo", "consumo_maximo", "total_registros",
]
ENRICHED_VALUES = [
    "consumo_promedio_historico", "importe_promedio_historico",
    "desviacion_consumo", "zscore_consumo", "porcentaje_variacion",
]
ANOMALY_FACT = [
    "id_anomalia", "nro_doc_fac", "periodo", "consumo_actual", "importe_actual",
    "distrito", "tarifa", "cartera",
    "consumo_promedio_historico", "importe_promedio_historico",
    "desviacion_consumo", "zscore_consumo", "porcentaje_variacion",
    "tipo_anomalia", "nivel_riesgo", "fecha_deteccion", "flag_anomalia",
]
