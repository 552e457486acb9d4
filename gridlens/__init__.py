"""Consumption analytics as parameterised Spark DataFrame operators."""

from gridlens.roles import Roles
from gridlens.session import build_session, settle, tune

__all__ = ["Roles", "build_session", "settle", "tune"]
