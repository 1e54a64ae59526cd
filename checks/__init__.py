"""Registered queries over the test tables, each with an independent SQL statement."""

from checks import exploration, modelling, preparation, scoring

MODULES = (preparation, exploration, modelling, scoring)
