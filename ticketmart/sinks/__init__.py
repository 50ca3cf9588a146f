"""Warehouse tables and exports."""
