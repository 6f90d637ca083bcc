"""Sources and sinks: JSON arrays, CSV, RSS, HTML pages, charts, playlists, profiles."""
