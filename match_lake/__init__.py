"""Spark DataFrame operators for a lake of game-match documents."""
