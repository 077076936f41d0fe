"""Query plans over the driver's tables: stand-ins for play-by-play, games,
player-weeks and pages, the registry of named queries, and their SQL oracles."""
