"""Input contracts, output tables and the writers that make re-runs safe."""
