"""Which column plays which part. Every operator takes a ``Roles`` and never hard-codes a raw column."""

from __future__ import annotations

from dataclasses import dataclass


# The documented raw column names of the monthly invoice tables.
@dataclass(frozen=True)
class Roles:
    service: str = "NRO_SERVICIO"
    document: str = "NRO_DOC_FAC"
    period: str = "PERIODO"
    consumption: str = "CONSUMO"
    amount: str = "IMPORTE"
    issued: str = "FECHA_EMISION"
    due: str = "FECHA_VENCIMIENTO"
    read_from: str = "FECHA_CONSUMO_DESDE"
    read_to: str = "FECHA_CONSUMO_HASTA"
    department: str = "DEPARTAMENTO"
    province: str = "PROVINCIA"
    district: str = "DISTRITO"
    geo_code: str = "UBIGEO"
    tariff: str = "TARIFA"
    portfolio: str = "CARTERA"
    unit: str = "UNIDAD_NEGOCIO"
    event_time: str = "kafka_timestamp"

    @property
    def dates(self) -> list[str]:
        return [self.issued, self.due, self.read_from, self.read_to]

    @property
    def measures(self) -> list[str]:
        return [self.consumption, self.amount]

    @property
    def fact(self) -> list[str]:
        return [self.document, self.period, *self.measures, *self.dates]

    @property
    def location(self) -> list[str]:
        return [
            self.department, self.province, self.district, self.geo_code,
            self.tariff, self.portfolio, self.unit,
        ]

    @property
    def dim(self) -> list[str]:
        return [self.document, *self.location]

    @property
    def group(self) -> list[str]:
        """Grain of the historical statistics."""
        return [self.district, self.tariff, self.portfolio]


DEFAULT = Roles()
